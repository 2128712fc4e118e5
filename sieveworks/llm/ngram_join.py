"""Similarity self-join on word n-grams: rare-first prefix filtering, then exact verification."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, connected_components, discarded, executors_back, free, give_back, handed_out, heap_back, mixed, read_table, small, stored, taken_in, windowed

#: Slots of the table of shingle frequencies; 4 bytes each are broadcast, at any size of the input.
SLOTS = 1 << 22

#: Slots in a row of that table as it is summed up.
SLICE = 1 << 12

#: Occurrences in a slot from which its shingles' buckets are dealt out, or eight times the mean.
BUSY = 20_000

#: Salts of a shingle at most, and bits of a size or a place where they are packed.
SALTS, FIELD = 128, 28

#: Bits of the suffix filter's hash ranges, and a count in one that may be more.
MIN_BITS, MAX_BITS, OPEN = 6, 14, 65_535

#: Rows of a bucket up to which its sets are paired by shared places; the sets of larger ones meet by family.
PAIRED = 32

#: Sets and shingles of a family that meet in one block, and bits of a Bloom filter at most.
FAMILY_ROWS, FAMILY_SHINGLES, BLOOM_BITS = 2000, 1 << 20, 1 << 26


def shingles(hashes: WordHashes, text: str | None, n: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's n-word shingles; of the whole sequence if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    return np.unique(windowed(h, list(range(min(n, len(h))))))


def signature(s: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed number."""
    import xxhash

    return int(np.array(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)), np.uint64).astype(np.int64)) if len(s) else 0


def _sets(batch: pa.RecordBatch, hashes: WordHashes, n: int):
    for text in batch.column("text").to_pylist():
        s = shingles(hashes, text, n)
        yield s, signature(s)


def _slots(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(SLOTS - 1)).astype(np.int64)


def profile(s: np.ndarray) -> bytes:
    """How many shingles fall in each of 2^k ranges of the hash, about as many ranges as shingles; 255 stands for more too."""
    bits = min(MAX_BITS, max(MIN_BITS, len(s).bit_length()))
    return np.minimum(np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


class Profiles:
    """Profiles of several sets, folded to a common number of ranges when two are compared."""

    def __init__(self, raw: list[bytes]):
        self.raw = [np.frombuffer(b, np.uint8) for b in raw]
        self.ranges = np.array([len(b) for b in raw], np.int64)
        self.folded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """The counts in that many ranges of all sets that have them, and each set's row there; OPEN for counts that may be more."""
        if ranges not in self.folded:
            own = np.flatnonzero(self.ranges >= ranges)
            row = np.full(len(self.raw), -1)
            row[own] = np.arange(len(own))
            table = np.empty((len(own), ranges), np.uint16)
            for k, i in enumerate(own.tolist()):
                parts = self.raw[i].astype(np.int64)
                parts[parts == 255] = OPEN
                table[k] = np.minimum(parts.reshape(ranges, -1).sum(1), OPEN)
            self.folded[ranges] = table, row
        return self.folded[ranges]

    def alike(self, x: int, others: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
        """Suffix filter: which of the others can share with x what the threshold asks for; the sets' rests, parted by hash ranges, share the smaller count of each range at most."""
        keep = np.zeros(len(others), bool)
        for ranges in np.unique(self.ranges[others]).tolist():
            at = np.flatnonzero(self.ranges[others] == ranges)
            fine = min(ranges, int(self.ranges[x]))
            for width in (fine >> 3, fine) if fine >= 512 else (fine,):  # most fail in few ranges
                table, row = self.at(width)
                low = np.minimum(table[row[others[at]]], table[row[x]])
                need = -(-percent * (size[others[at]] + size[x]) // (100 + percent))
                at = at[(low.sum(1, dtype=np.int64) >= need) | (low == OPEN).any(1)]
            keep[at] = True
        return keep


def surveyed(docs: DataFrame, n: int) -> tuple[DataFrame, np.ndarray]:
    """One pass over all texts: (doc_id, text_hash, size, sig, parts) of every row, and how often the shingles of each slot occur over all sets.

    Every task sums its documents up in a table of fixed size and hands it on in
    slices, which are added by slice; the table that is collected has a fixed
    size too.
    """

    def scan(batches):
        hashes, table = WordHashes(), np.zeros(SLOTS, np.int64)
        for batch in small(batches, "text"):
            got, slots = [], []
            for s, g in _sets(batch, hashes, n):
                got.append((len(s), g, profile(s) if len(s) else b""))
                slots.append(_slots(s))
                if len(slots) >= 2048:
                    table += np.bincount(np.concatenate(slots), minlength=SLOTS)
                    slots.clear()
            if slots:
                table += np.bincount(np.concatenate(slots), minlength=SLOTS)
            none = [None] * len(got)
            size, sig, parts = zip(*got, strict=True) if got else ((), (), ())
            yield _survey([batch.column("doc_id"), batch.column("text_hash"), size, sig, parts, none, none])
        rows = table.reshape(-1, SLICE)
        for i in np.flatnonzero(rows.any(1)).tolist():
            yield _survey([[None], [None], [None], [None], [None], [i], [zlib.compress(np.minimum(rows[i], 2**32 - 1).astype("<u4").tobytes(), 1)]])
        hashes = table = rows = got = slots = None
        give_back()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLICE, np.int64)
        for batch in batches:
            for c in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(c), "<u4")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())], names=["slice", "counts"])

    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    both = stored(hashed.mapInArrow(scan, "doc_id long, text_hash long, size int, sig long, parts binary, slice int, counts binary"), "survey")
    table = np.zeros(SLOTS, np.uint32)
    for r in both.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        table[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["counts"], "<u4")
    return both.where("slice is null").select("doc_id", "text_hash", "size", "sig", "parts"), table


def _survey(cols: list) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "text_hash": pa.int64(), "size": pa.int32(), "sig": pa.int64(), "parts": pa.binary(), "slice": pa.int32(), "counts": pa.binary()}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, kinds.values(), strict=True)], names=list(kinds))


def prefix_length(size: int, percent: int) -> int:
    """Of two sets that link, the first so many shingles in the common order share one."""
    return size - (-(-percent * size // 100)) + 1


def prefixes(docs: DataFrame, members: DataFrame, table: np.ndarray, n: int, percent: int) -> DataFrame:
    """(h, m, sig): the rarest shingles of each distinct set, as many as the threshold asks for.

    h holds the upper 40 bits of the hash (a shared place is only a candidate),
    m packs a salt, the set's size and the shingle's place in the prefix.  Of the
    copies of a set that with the smallest id stands for all, by a Bloom filter;
    what passes it besides gives equal rows, which neighbours() takes once.
    Shingles of very busy slots are dealt out by a salt from 1 on.
    """
    held = docs.sparkSession.sparkContext.broadcast(table)  # 4 * SLOTS bytes
    busy = max(BUSY, 8 * int(table.mean(dtype=np.float64)))
    first = members.where("size > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    owners = handed_out(docs.sparkSession, bloom_of(first.select(F.coalesce("doc_id", F.lit(0)).alias("key"))))

    def scan(batches):
        hashes, counts, bloom, seen = WordHashes(), held.value, taken_in(owners), set()
        for batch in small(batches, "text"):
            out = []
            batch = batch.filter(pa.array(bloom.has(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False))))
            for s, g in _sets(batch, hashes, n):
                if not len(s) or g in seen:
                    continue
                seen.add(g)
                k, often = prefix_length(len(s), percent), counts[_slots(s)]
                order = np.lexsort((s, often))[:k]
                salts = np.minimum(often[order] // np.uint32(busy), SALTS - 2).astype(np.uint64)
                h = s[order]
                salt = np.where(salts > 0, 1 + (mixed(h ^ np.int64(g).astype(np.uint64)) % (salts + np.uint64(1))).astype(np.int64), 0)
                out.append(((h >> np.uint64(24)).astype(np.int64), salt << 2 * FIELD | len(s) << FIELD | np.arange(k), np.full(k, g, np.int64)))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3
            for i in range(0, len(cols[0]), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 18)]) for c in cols], names=["h", "m", "sig"])
        hashes = counts = bloom = seen = out = cols = None
        give_back()

    rows = docs.select("doc_id", "text").mapInArrow(scan, "h long, m long, sig long")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "h", F.shiftright("m", 2 * FIELD)).sortWithinPartitions("h", F.shiftright("m", FIELD), "sig", "m")


def _possible(size, pos, size2, pos2, percent: int) -> np.ndarray:
    """Length and positional filter: whether the overlap still possible, with equal shingles at pos and pos2 of the ordered sets, reaches what the threshold asks for."""
    low, high = np.minimum(size, size2), np.maximum(size, size2)
    need = -(-percent * (size + size2) // (100 + percent))
    return (100 * low >= percent * high) & (1 + np.minimum(size - pos, size2 - pos2) - 1 + np.minimum(pos, pos2) >= need)


def _columns(batch: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for n in names]


def neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """From the rows of prefixes(): pairs (a, b), and the rows of large buckets (h, size, sig, pos).

    In a bucket, the sets with one shingle and salt, every set is paired with
    the one before it and with the first, which are all pairs of up to three.
    Rows of larger buckets, and salted ones, are handed on as well.  Equal rows,
    of copies of a set, count as one.  Memory doesn't grow with a bucket.
    """
    def unpacked(batch, last):
        h, m, sig = _columns(batch, ["h", "m", "sig"])
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (m[1:] != m[:-1]) | (sig[1:] != sig[:-1])
        if last and len(h):
            new[0] = last[0] != (h[0], m[0], sig[0])
        if len(h):
            last[:] = [(h[-1], m[-1], sig[-1])]
        h, m, sig = h[new], m[new], sig[new]
        return h, m >> 2 * FIELD, m >> FIELD & (1 << FIELD) - 1, sig, m & (1 << FIELD) - 1

    def scan(batches):
        pending = [np.empty(0, np.int64)] * 5
        run = None  # of a long bucket that goes on: its key, first and last row

        def work(cols, end):
            nonlocal pending, run
            h, salt, size, sig, pos = cols
            n = len(h)
            if not n:
                return None
            fresh = np.ones(n, bool)
            fresh[1:] = (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])
            goes_on = run is not None and run[0] == (h[0], salt[0])
            starts = np.flatnonzero(fresh)
            lengths = np.diff(np.append(starts, n))
            last_on = goes_on and len(starts) == 1
            if not end and lengths[-1] <= 3 and not last_on:
                cut = starts[-1]
                pending, run_after = [c[cut:] for c in cols], None
                h, salt, size, sig, pos = (c[:cut] for c in cols)
                n, starts, lengths = cut, starts[:-1], lengths[:-1]
            else:
                pending = [c[:0] for c in cols]
                first = run[1] if last_on else tuple(int(c[starts[-1]]) for c in (size, sig, pos))
                run_after = ((h[-1], salt[-1]), first, tuple(int(c[-1]) for c in (size, sig, pos)))
            if not n:
                run = run_after
                return None
            first = np.repeat(starts, lengths)
            index = np.arange(n) - first
            i = np.flatnonzero(index >= 1)
            k = np.flatnonzero(index >= 2)
            left, right = np.concatenate([i - 1, first[k]]), np.concatenate([i, k])
            pairs = [(size[left], sig[left], pos[left], size[right], sig[right], pos[right])]
            large = np.repeat(lengths > 3, lengths) | (salt > 0)
            if goes_on:
                m = lengths[0]
                large[:m] = True
                for row, upto in ((run[2], 1), (run[1], m)):
                    pairs.append((*(np.full(upto, v) for v in row), size[:upto], sig[:upto], pos[:upto]))
            run = run_after
            s, a, p, s2, b, p2 = (np.concatenate(c) for c in zip(*pairs, strict=True))
            keep = (a != b) & _possible(s, p, s2, p2, percent)
            a, b = np.minimum(a[keep], b[keep]), np.maximum(a[keep], b[keep])
            both = np.unique(np.stack([a, b]), axis=1) if len(a) else np.empty((2, 0), np.int64)
            out = [pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), *(pa.nulls(both.shape[1], t) for t in (pa.int64(), pa.int32(), pa.int32()))], names=["a", "b", "h", "size", "pos"])]
            if large.any():
                out.append(pa.RecordBatch.from_arrays([pa.array(sig[large]), pa.nulls(int(large.sum()), pa.int64()), pa.array(h[large]), pa.array(size[large].astype(np.int32)), pa.array(pos[large].astype(np.int32))], names=["a", "b", "h", "size", "pos"]))
            return out

        last = []
        for batch in batches:
            yield from work([np.concatenate(c) for c in zip(pending, unpacked(batch, last), strict=True)], False) or ()
        yield from work(pending, True) or ()

    return rows.mapInArrow(scan, "a long, b long, h long, size int, pos int")


def opened(large: DataFrame) -> DataFrame:
    """The rows (h, sig, size, pos, component) of buckets with sets of several components, and n, the rows of each bucket."""
    buckets = large.groupBy("h").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    return large.join(buckets.where("low < high").select("h", "n"), "h")


def sharing(rows: DataFrame, percent: int) -> DataFrame:
    """From rows of opened(), of buckets of up to PAIRED rows each: the pairs (a, b) of different components that share as many places of their prefixes as they must.

    Of two sets that link, all shared shingles but those that stand behind the
    prefix of one of them stand in both prefixes, so links of sets of like size
    share many.  That holds for pairs that share no place elsewhere: those of
    smaller buckets have been compared, those of larger ones meet by family.
    """
    a, b = (rows.select("h", *(F.col(c).alias(k + c) for c in ("sig", "size", "pos", "component"))) for k in "ab")
    low, high = F.least("asize", "bsize"), F.greatest("asize", "bsize")
    need = F.ceil(percent * (F.col("asize").cast("long") + F.col("bsize")) / (100 + percent))
    possible = F.least(F.col("asize") - F.col("apos"), F.col("bsize") - F.col("bpos")) + F.least("apos", "bpos") >= need
    both = a.join(b, "h").where(F.col("asig") < F.col("bsig")).where("acomponent <> bcomponent").where((100 * low.cast("long") >= percent * high.cast("long")) & possible)
    counted = both.groupBy(F.col("asig").alias("a"), F.col("bsig").alias("b"), "asize", "bsize").agg(F.count("*").alias("n"))
    behind = lambda size: F.ceil(percent * F.col(size).cast("long") / 100) - 1
    return counted.where(F.col("n") >= need - F.greatest(behind("asize"), behind("bsize"))).select("a", "b")


def families(large: DataFrame, percent: int) -> DataFrame:
    """(sig, component, family): the sets of large buckets (h, sig, size, component) whose bucket holds sets of another component and of like size, and the components that such buckets connect.

    Sets that can link differ in size by at most one band, a factor of 100 /
    percent, and each stands in its own band and the next.  Buckets are aggregated by component first, so a
    hot one is small.
    """
    wide = F.log(F.lit(100 / min(percent, 99)))
    band = F.floor(F.log(F.col("size").cast("double")) / wide + 1e-9).cast("int")
    rows = large.select("h", "sig", "component", F.explode(F.array(band, band + 1)).alias("band"))
    held = stored(rows.select("h", "band", "component").distinct(), "buckets")
    open_ = stored(held.groupBy("h", "band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h", "band", "low"), "open")
    edges = held.join(open_, ["h", "band"]).select(F.col("low").alias("a"), F.col("component").alias("b")).where("a <> b").distinct()
    of = connected_components(edges, "families").select(F.col("node").alias("component"), F.col("component").alias("family"))
    return rows.join(open_, ["h", "band"]).select("sig", "component").distinct().join(of, "component").select("sig", "component", "family")


def crossings(members: DataFrame, percent: int) -> DataFrame:
    """(family, i, j, a, b): the pairs of a family's sets in different components that pass the length and suffix filters.

    members has sig, component, family, size and parts.  The sets outside a
    family's largest component meet all of its sets, each pair once, in blocks
    i, j of bounded rows and shingles.
    """
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    main = sizes.groupBy("family").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "component", "w")).alias("top"))
    blocks = lambda n, w: F.greatest(F.ceil(n / FAMILY_ROWS), F.ceil(w / FAMILY_SHINGLES), F.lit(1)).cast("int")
    plan = main.select("family", F.col("top.component").alias("main"), blocks(F.col("n"), F.col("w")).alias("is"), blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("js"))
    placed = members.join(plan, "family").withColumn("minor", F.col("component") != F.col("main"))
    every = placed.select("family", F.pmod(F.xxhash64("sig"), F.col("is")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("js") - 1)).alias("j"), F.lit(False).alias("asks"), "sig", "component", "minor", "size", "parts")
    asks = placed.where("minor").select("family", F.explode(F.sequence(F.lit(0), F.col("is") - 1)).alias("i"), F.pmod(F.xxhash64("sig"), F.col("js")).cast("int").alias("j"), F.lit(True).alias("asks"), "sig", "component", "minor", "size", "parts")

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        asking, minor = (table.column(c).to_numpy() for c in ("asks", "minor"))
        sig, component, size = (table.column(c).to_numpy().astype(np.int64) for c in ("sig", "component", "size"))
        profiles, there = Profiles(table.column("parts").to_pylist()), np.flatnonzero(~asking)

        def rows(x: int, at: np.ndarray) -> pa.RecordBatch:
            keys = [pa.array([k.as_py()] * len(at), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays([*keys, pa.array(np.full(len(at), sig[x])), pa.array(sig[at])], names=["family", "i", "j", "a", "b"])

        for x in np.flatnonzero(asking).tolist():
            low, high = np.minimum(size[there], size[x]), np.maximum(size[there], size[x])
            at = there[(component[there] != component[x]) & (~minor[there] | (sig[there] > sig[x])) & (100 * low >= percent * high)]
            for lo in range(0, len(at), 512):
                near = at[lo : lo + 512]
                near = near[profiles.alike(x, near, size, percent)]
                if len(near):
                    yield rows(x, near)
        yield rows(0, there[:0])

    return every.unionByName(asks).groupBy("family", "i", "j").applyInArrow(meet, "family long, i int, j int, a long, b long")


def verified_in_blocks(pairs: DataFrame, kin: DataFrame, docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) among the pairs of crossings(); a set is sent once to a block, and pairs whose components a link found there connects are passed over."""
    keys = ["family", "i", "j"]
    need = stored(pairs.select(*keys, F.col("a").alias("sig")).union(pairs.select(*keys, F.col("b").alias("sig"))).distinct().join(kin.select("sig", "component"), "sig"), "need")
    sets = need.join(sets_of(docs, members, need.select("sig").distinct(), n), "sig")

    def check(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        own = dict(zip(sets.column("sig").to_pylist(), sets.column("shingles").to_pylist(), strict=True))
        of = dict(zip(sets.column("sig").to_pylist(), sets.column("component").to_pylist(), strict=True))
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while (up := root.get(c, c)) != c:
                root[c] = root.get(up, up)
                c = up
            return c

        links = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            x, y = find(of[a]), find(of[b])
            if x != y and linked(np.frombuffer(own[a], np.uint64), np.frombuffer(own[b], np.uint64), percent):
                root[x] = y
                links.append((a, b))
        return pa.table([pa.array([k[c] for k in links], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return pairs.groupBy(*keys).cogroup(sets.groupBy(*keys)).applyInArrow(check, "a long, b long")


def linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough, exactly."""
    both = np.concatenate([s, t])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


class Bloom:
    """Bits of a Bloom filter, of a size set by the number of keys up to BLOOM_BITS; beyond it only the filter's use declines."""

    def __init__(self, bits: int):
        self.bits, self.table = bits, np.zeros(bits // 8, np.uint8)

    @staticmethod
    def size(keys: int) -> int:
        return min(BLOOM_BITS, max(1 << 16, 1 << (16 * keys).bit_length()))

    def places(self, keys: np.ndarray) -> np.ndarray:
        h = mixed(keys.astype(np.int64).view(np.uint64))
        step = mixed(h) | np.uint64(1)
        return np.stack([(h + np.uint64(k) * step) & np.uint64(self.bits - 1) for k in range(4)])

    def add(self, keys: np.ndarray) -> None:
        p = self.places(keys).ravel()
        np.bitwise_or.at(self.table, (p >> np.uint64(3)).astype(np.int64), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        p = self.places(keys)
        return ((self.table[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1).all(0)


def bloom_of(keys: DataFrame) -> Bloom:
    """A Bloom filter of the long column key, put together from slices of the tasks' own."""
    bloom, width = Bloom(Bloom.size(keys.count())), 1 << 13

    def scan(batches):
        own = Bloom(bloom.bits)
        for batch in batches:
            own.add(batch.column(0).to_numpy(zero_copy_only=False))
        rows = own.table.reshape(-1, width)
        used = np.flatnonzero(rows.any(1)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([rows[i].tobytes() for i in used], pa.binary())], names=["slice", "bits"])

    def union(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.uint8)
        for batch in batches:
            for b in batch.column("bits").to_pylist():
                total |= np.frombuffer(b, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["slice", "bits"])

    schema = "slice int, bits binary"
    for r in keys.select("key").mapInArrow(scan, schema).groupBy("slice").applyInArrow(union, schema).collect():
        bloom.table[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return bloom


def sets_of(docs: DataFrame, members: DataFrame, sigs: DataFrame, n: int) -> DataFrame:
    """(sig, shingles): the set of each of the given signatures, from one document that has it.

    A Bloom filter of those documents' ids spares the others; no text is shuffled.
    """
    owners = members.join(sigs, "sig").groupBy("sig").agg(F.min("doc_id").alias("doc_id"))
    held = handed_out(docs.sparkSession, bloom_of(owners.select(F.coalesce("doc_id", F.lit(0)).alias("key"))))

    def scan(batches):
        hashes, bloom, seen = WordHashes(), taken_in(held), set()
        for batch in small(batches, "text"):
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            own = batch.filter(pa.array(bloom.has(ids)))
            got = []
            for s, g in _sets(own, hashes, n):
                if len(s) and g not in seen:
                    seen.add(g)
                    got.append((g, s.tobytes()))
            for i in range(0, len(got), 500):
                part = got[i : i + 500]
                yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in part], pa.int64()), pa.array([s for _, s in part], pa.binary())], names=["sig", "shingles"])
        hashes = bloom = seen = own = got = part = None
        give_back()

    return docs.select("doc_id", "text").mapInArrow(scan, "sig long, shingles binary").join(sigs, "sig").dropDuplicates(["sig"])


def plausible(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs that pass the suffix filter."""
    each = members.where("size > 0").groupBy("sig").agg(F.any_value("parts").alias("parts"), F.any_value("size").alias("size"))
    a, b = (each.select(F.col("sig").alias(k), F.col("parts").alias(f"{k}parts"), F.col("size").alias(f"{k}size")) for k in "ab")

    def scan(batches):
        for batch in batches:
            sizes, keep = np.stack(_columns(batch, ["asize", "bsize"]), axis=1), []
            for two, size in zip(zip(batch.column("aparts").to_pylist(), batch.column("bparts").to_pylist(), strict=True), sizes, strict=True):
                keep.append(bool(Profiles(list(two)).alike(0, np.array([1]), size, percent)[0]))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").distinct().join(a, "a").join(b, "b").select("a", "b", "aparts", "bparts", "asize", "bsize").mapInArrow(scan, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link; each is compared once."""
    sigs = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, members, sigs, n)  # both joins read one exchange
    a, b = (sets.select(F.col("sig").alias(k), F.col("shingles").alias(f"{k}set")) for k in "ab")

    def scan(batches):
        for batch in batches:
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column("aset").to_pylist(), batch.column("bset").to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "aset", "bset").mapInArrow(scan, "a long, b long")


def linked_sets(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows of surveyed(), and (sig, component) of the sets that have a link.

    What is read no more, tables and shuffles, goes as soon as the next step is written.
    """
    spark = docs.sparkSession
    executors_back(spark)
    members, table = surveyed(docs, n)
    heap_back(spark)
    found = stored(neighbours(prefixes(docs, members, table, n, percent), percent), "neighbours")
    del table
    heap_back(spark)
    executors_back(spark)
    pairs = stored(plausible(found.where("b is not null"), members, percent), "pairs")
    heap_back(spark)
    links = stored(verified(pairs, docs, members, n, percent), "links")
    heap_back(spark)
    labels = connected_components(links, "labels")

    large = found.where("b is null").select("h", F.col("a").alias("sig"), "size", "pos").join(labels.withColumnRenamed("node", "sig"), "sig", "left")
    large = stored(opened(large.withColumn("component", F.coalesce("component", "sig"))), "large")
    discarded(found)
    heap_back(spark)

    near = stored(plausible(sharing(large.where(F.col("n") <= PAIRED), percent).join(pairs, ["a", "b"], "left_anti"), members, percent), "sharing")
    discarded(pairs)
    more = not near.isEmpty()
    if more:
        links = stored(links.union(verified(near, docs, members, n, percent)), "links")
    heap_back(spark)
    kin = stored(families(large.where(F.col("n") > PAIRED), percent), "kin")
    discarded(large)
    heap_back(spark)
    each = members.where("size > 0").groupBy("sig").agg(F.any_value("parts").alias("parts"), F.any_value("size").alias("size"))
    crossed = stored(crossings(kin.join(each, "sig"), percent), "crossings")
    heap_back(spark)
    if not crossed.isEmpty():
        links, more = stored(links.union(verified_in_blocks(crossed, kin, docs, members, n, percent)), "links"), True
    if more:
        labels = connected_components(links, "labels")
    discarded(crossed)
    heap_back(spark)
    return members, labels.select(F.col("node").alias("sig"), "component")


def _plain(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def components(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents are linked when their sets' Jaccard similarity is percent / 100 or more.

    Words are runs of other than ASCII white space, with A-Z lower-cased; a set
    holds the 64-bit hashes of the distinct n-word shingles, or of the whole
    sequence if it is shorter.  Equal sets are one node.  Shingles are ordered
    by rarity (the count of a hash slot, then the hash), and a set's prefix, all
    that a linked set needs to share one shingle with, is joined by shingle.

    All pairs of a bucket are not made at once: first each set meets its
    neighbours there, pairs that pass the length, positional and suffix filters
    are verified, and links give components; then pairs of different components
    that larger buckets bring together are verified too: in buckets of up to
    PAIRED sets those that share enough of their prefixes, beyond it all that
    pass the length and suffix filters.  A pair left out is connected already or
    can't link, so the components are exact.

    Null and wordless texts have empty sets, are linked with nothing and keep
    their own id; a null id stays null and counts only if no other id is in its
    component; rows with equal ids are separate documents; other columns, whatever
    their names, are ignored; an empty table gives no rows.  Texts of any length
    are taken whole; the longest one's words are in a worker's memory at once.
    """
    members, labels = linked_sets(_plain(documents, doc_id, text), n, percent)
    own = members.where("size > 0").groupBy("sig").agg(F.min("doc_id").alias("low")).join(labels, "sig", "left")
    own = own.withColumn("component", F.coalesce("component", "sig"))
    lowest = own.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = own.join(lowest, "component").select("sig", "component_id")
    linked = members.where("size > 0").join(by_set, "sig").select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")
    return linked.unionByName(members.where("size = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """The rows of documents, all columns, without those that another of their component stands for; see components().

    The row with the smallest id stays (null counts as the largest), of equal
    ids that with the smallest hash of its text, of equal texts one.  Null and
    wordless texts all stay.  Other columns may have any names; an empty table
    stays empty; texts of any length are taken whole.
    """
    members, labels = linked_sets(_plain(documents, doc_id, text), n, percent)
    place = F.struct(F.col("doc_id").isNull().alias("null"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash"))
    own = members.where("size > 0").groupBy("sig").agg(F.min(place).alias("first")).join(labels, "sig", "left")
    stays = own.groupBy(F.coalesce("component", "sig").alias("component")).agg(F.min("first").alias("first")).select("first.*")
    *names, key = free(documents.columns, "null", "id", "hash", "key")
    stays = stored(stays.toDF(*names), "stays")
    rows = members.where("size > 0").select(place.alias("p")).select("p.*").toDF(*names).groupBy(*names).agg(F.count("*").alias("n"))
    doubtful = rows.join(stays.withColumn("one", F.lit(True)), names, "left").where("one is null or n > 1").select(F.xxhash64(*names).alias("key"))
    held = handed_out(documents.sparkSession, bloom_of(doubtful))
    placed = documents.withColumns(dict(zip(names, (F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), F.xxhash64(F.coalesce(F.col(text), F.lit("")))), strict=True)))
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    placed = placed.withColumn(key, F.when(worded, F.xxhash64(*names)))

    def sift(batches, doubted):
        bloom = taken_in(held)
        for batch in batches:
            keys = batch.column(key)
            hit = bloom.has(keys.fill_null(0).to_numpy(zero_copy_only=False)) & ~keys.is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit == doubted))

    sure = placed.mapInArrow(lambda batches: sift(batches, False), placed.schema)
    tested = placed.mapInArrow(lambda batches: sift(batches, True), placed.schema).join(stays, names, "left_semi").dropDuplicates(names)
    return sure.select(documents.columns).unionByName(tested.select(documents.columns))


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Every document's set size and component at five words and 0.75."""
    return components(read_table(spark, sf_dir, "documents"))


#: Shingle sets as lists, all pairs that share a shingle, and the ids reachable over links, downwards.
OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w
), e AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), l AS (
  SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b
)
SELECT s.doc_id, len(any_value(s.sh))::BIGINT AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id
"""
