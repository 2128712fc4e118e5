"""Toxicity by a small convolutional text classifier, trained in tasks on all labelled documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import running
from .common import CACHE_WORDS, crc_mod, discarded, give_back, handed_out, heap_back, plain_words, read_table, small, stored, taken_in

#: Rows of hashed embeddings, their length, the widths of the filters and the filters of each width.
ROWS, DIM, WIDTHS, FILTERS = 1 << 15, 16, (1, 2, 3), 16

#: Up to so many labelled documents and words one network learns at a time, on the driver; beyond either, tasks learn from shards of about SHARD_TEXTS documents and SHARD_WORDS words at most.
FEW_TEXTS, SHARD_TEXTS, SHARD_WORDS = 2048, 4096, 4 << 20

#: Folds whose texts are scored, for the thresholds, by a network that learned from the other folds: where labels are few, and among shards.
FOLDS, HALVES = 4, 2

#: Rounds in which shards learn from the same weights, which are then put together, and the steps of a shard in a round at least.
ROUNDS, LEAST_STEPS = 2, 100

#: Changes of weights and squares of gradients are added up as whole numbers of these parts, so that sums don't depend on their order.
WEIGHT_PARTS, SQUARE_PARTS = 1 << 24, 1 << 32

#: Bits that labelled ids are marked in before texts are shuffled (8 MB; beyond some 20 million labels they spare fewer texts, the result is the same), and those of a row.
MARKS, MARKS_A_ROW = 1 << 26, 1 << 15

#: Examples of each class that a language needs for a threshold of its own.
OWN_THRESHOLD = 8

#: A word has one embedding of its own and one for its beginning, which related forms share.
STEM = 4

#: Frequent function words by which a text's language is recognised.
FUNCTION_WORDS = {
    "en": "the of and to in is that it for with as was on are by this be from at an or not",
    "fr": "le la les de des du et en un une que qui dans pour pas est au aux par sur avec",
    "de": "der die das und ist zu den von mit ein eine nicht auf für im dem des sich auch als",
    "es": "el la los las de del y en que un una por con para es se no su al lo como más",
}
LANGUAGES = (*FUNCTION_WORDS, "other")

#: Words convolved at once.
STRIDE = 1 << 12


class Vocabulary(dict):
    """Word to (row of the word, row of its beginning, languages it speaks for), bounded in size."""

    def __init__(self):
        super().__init__()
        self.votes = {}
        for k, words in enumerate(FUNCTION_WORDS.values()):
            for w in words.split():
                self.votes[w.encode()] = self.votes.get(w.encode(), 0) | 1 << k

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        stem = word.decode("utf-8", "ignore")[:STEM]
        at = xxhash.xxh3_64_intdigest(word) % (ROWS // 2), ROWS // 2 + xxhash.xxh3_64_intdigest(stem.encode(), seed=1) % (ROWS // 2)
        v = self[word] = at[0] | at[1] << 16 | self.votes.get(word, 0) << 32
        return v

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows of words, rows of beginnings, and the language by the most votes ("other" without any)."""
        words = plain_words(text)
        v = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        votes = v >> 32
        counts = [int(np.count_nonzero(votes & (1 << k))) for k in range(len(FUNCTION_WORDS))]
        lang = int(np.argmax(counts)) if max(counts) else len(FUNCTION_WORDS)
        return (v & 0xFFFF).astype(np.int32), ((v >> 16) & 0xFFFF).astype(np.int32), lang


class Network:
    """Embeddings, convolutions with ReLU and max pooling over the whole text, and one logistic unit."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.05, (ROWS, DIM)).astype(np.float32)
        self.conv = [r.normal(0, 1 / np.sqrt(DIM * k), (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.scale = np.ones(len(LANGUAGES))
        self.threshold = np.zeros(len(LANGUAGES))

    def filtered(self, words: np.ndarray, stems: np.ndarray, kernels: np.ndarray):
        """(filters' width number, place of the first window, values by filter and window), in strides; texts shorter than a filter end in blanks."""
        n = len(words)
        for start in range(0, max(1, n), STRIDE):
            stop = min(n, start + STRIDE + WIDTHS[-1] - 1)
            x = np.zeros((max(stop - start, WIDTHS[-1]), DIM), np.float32)
            np.add(self.embed[words[start:stop]], self.embed[stems[start:stop]], out=x[: stop - start])
            y, lo = kernels @ x.T, 0
            for k, w in enumerate(WIDTHS):
                m = min(STRIDE, max(n, w) - w + 1 - start)
                if m > 0:
                    v = y[lo : lo + FILTERS, :m]
                    for j in range(1, w):
                        v = v + y[lo + j * FILTERS : lo + (j + 1) * FILTERS, j : j + m]
                    yield k, start, v
                lo += w * FILTERS

    def kernels(self) -> np.ndarray:
        """The filters of all widths and places below each other."""
        return np.concatenate([c[j].T for c in self.conv for j in range(len(c))])

    def pooled(self, words: np.ndarray, stems: np.ndarray, kernels: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """The pooled features of one text and where each was found."""
        top, at = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
        for k, start, v in self.filtered(words, stems, self.kernels() if kernels is None else kernels):
            i = v.argmax(1)
            found = v[np.arange(FILTERS), i]
            better = found > top[k]
            top[k, better], at[k, better] = found[better], i[better] + start
        return np.maximum((top + np.stack(self.bias)).ravel(), 0), list(at)

    def logit(self, words: np.ndarray, stems: np.ndarray, kernels: np.ndarray | None = None) -> float:
        top = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
        for k, _, v in self.filtered(words, stems, self.kernels() if kernels is None else kernels):
            np.maximum(top[k], v.max(1), out=top[k])
        return float(np.maximum((top + np.stack(self.bias)).ravel(), 0) @ self.out + self.shift[0])

    def train(self, texts: list[tuple[np.ndarray, np.ndarray, int]], y: np.ndarray, epochs: int = 4, batch: int = 32, rate: float = 0.05, seed: int = 7, least_steps: int = 200) -> None:
        """Learns from the texts alone; classes weigh alike."""
        learner = Learner(self)
        counts = [int((y == c).sum()) for c in (0, 1)]
        learner.learn(texts, y, class_weights(counts), max(epochs, -(-least_steps * batch // max(1, len(y)))), batch, rate, seed)
        learner.clear()

    def calibrate(self, logits: np.ndarray, y: np.ndarray, langs: np.ndarray) -> None:
        """For each recognised language the threshold with the fewest errors, in the middle of its gap; languages with few examples of a class use that of all."""
        self.threshold[:] = best_threshold(logits, y, 0.0)
        for k in range(len(LANGUAGES)):
            own = langs == k
            if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= OWN_THRESHOLD:
                self.threshold[k] = best_threshold(logits[own], y[own], self.threshold[k])

    def score(self, logit: float, lang: int) -> float:
        """0.5 at the language's threshold."""
        return float(1 / (1 + np.exp(-np.clip(logit - self.threshold[lang], -30, 30))))


def class_weights(counts: list[int]) -> np.ndarray:
    """The weight of a text of each class, so that classes weigh alike and a text 1 on average."""
    return np.array([0.5 * sum(counts) / max(1, c) for c in counts])


class Learner:
    """A network and the squares of its gradients (Adagrad on the logistic loss).  Gradients pass through the pooled positions only."""

    def __init__(self, net: Network):
        self.net = net
        self.squares, self.rows = [np.full(p.shape, 1e-8, np.float32) for p in self.dense()], np.full(ROWS, 1e-8, np.float32)

    def dense(self) -> list[np.ndarray]:
        return [*self.net.conv, *self.net.bias, self.net.out, self.net.shift]

    def learn(self, texts: list[tuple[np.ndarray, np.ndarray, int]], y: np.ndarray, weights: np.ndarray, epochs: int, batch: int = 32, rate: float = 0.05, seed: int | list[int] = 7) -> None:
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            perm = order.permutation(len(y))
            for lo in range(0, len(y), batch):
                own = perm[lo : lo + batch]
                self.step([texts[i] for i in own], y[own], weights[y[own]], rate)

    def step(self, texts: list[tuple[np.ndarray, np.ndarray, int]], y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        net, kernels, n = self.net, self.net.kernels(), len(texts)
        found = [net.pooled(words, stems, kernels) for words, stems, _ in texts]
        f, where = np.stack([v for v, _ in found]), np.stack([at for _, at in found])  # text, feature; text, width, filter
        g = (weight * (1 / (1 + np.exp(-np.clip(f @ net.out + net.shift[0], -30, 30))) - y) / n).astype(np.float32)
        back = (g[:, None] * net.out * (f > 0)).reshape(n, len(WIDTHS), FILTERS)
        grads = [np.zeros_like(c) for c in net.conv] + list(back.sum(0)) + [g @ f, g.sum(keepdims=True)]
        lengths = np.array([len(words) for words, *_ in texts])
        words, stems = (np.concatenate([t[k] for t in texts]).astype(np.int64) for k in (0, 1))
        first = (np.cumsum(lengths) - lengths)[:, None]
        touched, change = [], []
        for k, w in enumerate(WIDTHS):
            for j in range(w):
                text, filt = np.nonzero((where[:, k] + j < lengths[:, None]) & (back[:, k] != 0))
                at = (first + where[:, k] + j)[text, filt]
                a, b, d = words[at], stems[at], back[text, k, filt][:, None]
                np.add.at(grads[k][j].T, filt, (net.embed[a] + net.embed[b]) * d)
                touched += [a, b]
                change += [net.conv[k][j].T[filt] * d] * 2
        for p, v, s in zip(self.dense(), grads, self.squares, strict=True):
            s += v * v
            p -= rate * v / np.sqrt(s)
        touched = np.concatenate(touched)
        if len(touched):
            order = np.argsort(touched, kind="stable")
            at, starts = np.unique(touched[order], return_index=True)
            v = np.add.reduceat(np.concatenate(change)[order], starts)
            self.rows[at] += (v * v).mean(1)
            net.embed[at] -= rate * v / np.sqrt(self.rows[at])[:, None]

    def clear(self) -> None:
        """Words that no filter ever chose say nothing."""
        self.net.embed[self.rows <= np.float32(1e-8)] = 0

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """All weights in rows of DIM, those of words first, and their squares: one for a row of a word, in its first place."""
        flat = [np.concatenate([v.ravel() for v in part]) for part in (self.dense(), self.squares)]
        weights, squares = (np.pad(v, (0, -len(v) % DIM)).reshape(-1, DIM) for v in flat)
        return np.concatenate([self.net.embed, weights]).astype(np.float64), np.concatenate([np.pad(self.rows[:, None], ((0, 0), (0, DIM - 1))), squares]).astype(np.float64)

    def unpack(self, weights: np.ndarray, squares: np.ndarray) -> None:
        self.net.embed[:], self.rows[:] = weights[:ROWS], squares[:ROWS, 0]
        for own, new in ((self.dense(), weights), (self.squares, squares)):
            flat, lo = new[ROWS:].ravel(), 0
            for p in own:
                p[...] = flat[lo : lo + p.size].reshape(p.shape)
                lo += p.size


def best_threshold(logits: np.ndarray, y: np.ndarray, default: float) -> float:
    """The cut with the smallest sum of both classes' error rates; the middle of the widest of equal gaps."""
    if not (y == 1).any() or not (y == 0).any():
        return default
    order = np.argsort(logits, kind="stable")
    s, t = logits[order], y[order]
    errors = np.concatenate([[0], np.cumsum(t == 1)]) / (t == 1).sum() + np.concatenate([[0], np.cumsum((t == 0)[::-1])])[::-1] / (t == 0).sum()
    edges = np.concatenate([[s[0] - 1], s, [s[-1] + 1]])
    gaps = np.diff(edges)
    gaps[gaps <= 0] = -1
    best = np.flatnonzero(errors == errors[gaps > 0].min())
    best = best[np.argmax(gaps[best])]
    return float((edges[best] + edges[best + 1]) / 2)


def fitted(texts: list[tuple[np.ndarray, np.ndarray, int]], y: np.ndarray, hashes: np.ndarray) -> Network:
    """A network that learns from all texts; its thresholds come from all texts too, each scored by one of FOLDS networks that learned from the others."""
    net, langs, found = Network(), np.array([t[2] for t in texts]), np.zeros(len(y))
    for k in range(FOLDS):
        own, fit, other = np.flatnonzero(hashes % FOLDS == k), np.flatnonzero(hashes % FOLDS != k), Network()
        if len(own) and len(fit):
            other.train([texts[i] for i in fit], y[fit])
            found[own] = [other.logit(*texts[i][:2]) for i in own]
    net.train(texts, y)
    net.calibrate(found, y, langs)
    return net


def maybe_among(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The texts whose id is that of a row of known, and few others: ids are compared by one hashed bit each, so that texts without labels need no shuffle."""
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    bit, row = (mark % MARKS_A_ROW).alias("__bit"), F.floor(mark / MARKS_A_ROW).alias("__row")
    marks = known.select(bit, row).groupBy("__row").agg(F.bitmap_construct_agg("__bit").alias("__marks"))  # MARKS bits in all
    byte = F.conv(F.hex(F.expr("substring(__marks, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return texts.withColumns({"__bit": bit, "__row": row}).join(F.broadcast(marks), "__row").where(F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1).select(*texts.columns)


def labelled_words(documents: DataFrame, labels: DataFrame, *, label: str = "toxic", fold: int = 5, held_out: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, y, lang and words (four bytes each) of every labelled document outside the held-out fold.

    Of several labels of a document the largest counts, of several texts the
    smallest.  Null ids, labels and texts are left out.
    """
    key = F.col(doc_id).cast("long").alias("doc_id")
    known = labels.select(key, F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(crc_mod("doc_id", fold) != held_out)
    texts = documents.select(key, F.col(text).alias("text")).where("doc_id is not null and text is not null").where(crc_mod("doc_id", fold) != held_out)
    found = maybe_among(texts, known).groupBy("doc_id").agg(F.min("text").alias("text")).join(known.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id")

    def encode(batches):
        vocabulary = Vocabulary()
        for batch in small(batches, "text"):
            got = [vocabulary.of(t) for t in batch.column("text").to_pylist()]
            packed = [(words.astype(np.uint32) | stems.astype(np.uint32) << np.uint32(16)).tobytes() for words, stems, _ in got]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array([lang for *_, lang in got], pa.int32()), pa.array(packed, pa.binary())], names=["doc_id", "y", "lang", "words"])
        vocabulary = None
        give_back()

    return found.select("doc_id", "y", "text").mapInArrow(encode, "doc_id long, y int, lang int, words binary")


def texts_of(rows: pa.Table | pa.RecordBatch) -> tuple[list[tuple[np.ndarray, np.ndarray, int]], np.ndarray]:
    """The texts and labels of rows of labelled_words()."""
    held = [np.frombuffer(w, np.uint32) for w in rows.column("words").to_pylist()]
    langs = rows.column("lang").to_pylist()
    return [((w & np.uint32(0xFFFF)).astype(np.int32), (w >> np.uint32(16)).astype(np.int32), lang) for w, lang in zip(held, langs, strict=True)], rows.column("y").to_numpy().astype(np.int64)


CHANGES = ["net", "row", "touched", *(f"v{k}" for k in range(DIM)), *(f"s{k}" for k in range(DIM))]


def shard_changes(held, weights: np.ndarray, r: int):
    """For a shard's rows in round r: what learning from them changes, in CHANGES, in every network that may learn from the shard."""

    def learn(key, table):
        learners, shard = taken_in(held), key[0].as_py()
        texts, y = texts_of(table.sort_by("doc_id"))
        epochs, parts = max(1, -(-LEAST_STEPS * 32 // len(y))), []
        for k, own in enumerate(learners):
            if k == shard % HALVES + 1:
                continue
            before, squares = own.packed()
            own.learn(texts, y, weights, epochs, seed=[7, r, shard])
            after, grown = own.packed()
            at = np.flatnonzero((grown != squares).any(1) | (np.arange(len(grown)) >= ROWS))
            v, s = np.rint((after - before)[at] * WEIGHT_PARTS).astype(np.int64), np.rint(grown[at] * SQUARE_PARTS).astype(np.int64)
            parts.append(pa.table([np.full(len(at), k), at, np.ones(len(at), np.int64), *v.T, *s.T], names=CHANGES))
        return pa.concat_tables(parts)

    return learn


def put_together(rows: DataFrame, shards: int, counts: list[int]) -> list[Network]:
    """Networks that learned from all shards, and from all but each of HALVES; rows are those of labelled_words() with a shard.

    In each round every shard learns from the same weights, for itself and in an
    order of its own; a row of weights then changes by the mean over the shards
    that touched it.  Only these means, of the size of the networks, come to the
    driver.  The result does not depend on partitions.
    """
    spark, learners, weights = rows.sparkSession, [Learner(Network()) for _ in range(HALVES + 1)], class_weights(counts)
    for r in range(ROUNDS):
        held = handed_out(spark, learners)
        sums = rows.groupBy("shard").applyInArrow(shard_changes(held, weights, r), ", ".join(f"{c} long" for c in CHANGES)).groupBy("net", "row").agg(*(F.sum(c).alias(c) for c in CHANGES[2:]))
        got = sums.toArrow()
        net, at, touched, *values = (c.to_numpy() for c in got.columns)
        v, s = (np.stack(part, 1) / touched[:, None] for part in (values[:DIM], values[DIM:]))
        for k, own in enumerate(learners):
            mine = net == k
            w, squares = own.packed()
            w[at[mine]] += v[mine] / WEIGHT_PARTS
            squares[at[mine]] = s[mine] / SQUARE_PARTS
            own.unpack(w, squares)
        held.destroy()
        del sums, got
        heap_back(spark)  # a round's shuffles
    for own in learners:
        own.clear()
    return [own.net for own in learners]


def thresholds(logits: DataFrame) -> np.ndarray:
    """What Network.calibrate() finds, from rows of any number (lang, logit, y): exact counts beside every cut, and the best cuts only come to the driver."""
    each = logits.select("lang", "logit", "y").unionByName(logits.select(F.lit(len(LANGUAGES)).alias("lang"), "logit", "y"))
    cuts = each.groupBy("lang", "logit").agg(F.sum("y").cast("long").alias("ones"), F.sum(1 - F.col("y")).cast("long").alias("zeros"))
    cuts = stored(running(cuts, ["lang"], ["logit"], number="n", sums={"below": "ones", "clean": "zeros"}), "cuts")
    ends = cuts.groupBy("lang").agg(F.sum("ones").alias("all_ones"), F.sum("zeros").alias("all_zeros"), F.min("logit").alias("first"))
    after = cuts.select("lang", (F.col("n") - 1).alias("n"), F.col("logit").alias("next"))
    cuts = cuts.join(after, ["lang", "n"], "left").join(F.broadcast(ends), "lang").withColumn("next", F.coalesce("next", F.col("logit") + 1))
    wrong = F.col("below").cast("decimal(19,0)") * F.col("all_zeros") + (F.col("all_zeros") - F.col("clean")).cast("decimal(19,0)") * F.col("all_ones")
    best = cuts.groupBy("lang", "all_ones", "all_zeros", "first").agg(F.min(F.struct(wrong.alias("wrong"), (F.col("logit") - F.col("next")).alias("gap"), "logit", "next")).alias("best"))
    found = {}
    for r in best.collect():  # a row a language
        cut = (r.best.logit + r.best.next) / 2
        found[r.lang] = r.all_ones, r.all_zeros, r["first"] - 0.5 if (r.all_ones * r.all_zeros, -1.0) <= (int(r.best.wrong), r.best.gap) else cut
    ones, zeros, of_all = found.get(len(LANGUAGES), (0, 0, 0.0))
    default = of_all if ones and zeros else 0.0
    return np.array([found[k][2] if k in found and min(found[k][:2]) >= OWN_THRESHOLD else default for k in range(len(LANGUAGES))])


def train(documents: DataFrame, labels: DataFrame, *, label: str = "toxic", fold: int = 5, held_out: int = 0, doc_id: str = "doc_id", text: str = "text") -> Network:
    """A network that learned from all labelled documents outside the held-out fold, its thresholds set on all of them; labelled_words() says what nulls and repeated rows do.

    Where labels are few the driver trains, see fitted().  Else tasks do, see
    put_together(), and every text is scored, for the thresholds, by the network
    that did not learn from its half.  Without any usable label the network is as
    it began, and its scores mean nothing.
    """
    rows = stored(labelled_words(documents, labels, label=label, fold=fold, held_out=held_out, doc_id=doc_id, text=text), "labelled")
    heap_back(rows.sparkSession)  # the shuffle of the texts
    size = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), F.sum(F.octet_length("words").cast("long") / 4).alias("words")).first()
    if not size.n:
        net = Network()
    elif size.n <= FEW_TEXTS and size.words <= SHARD_WORDS:
        all_rows = rows.toArrow().sort_by("doc_id")
        net = fitted(*texts_of(all_rows), np.array([xxhash.xxh3_64_intdigest(str(i)) for i in all_rows.column("doc_id").to_pylist()], np.uint64))
        del all_rows
    else:
        shards = max(HALVES, -(-size.n // SHARD_TEXTS), -(-int(size.words) // SHARD_WORDS))
        rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
        net, *others = put_together(rows, shards, [size.n - size.ones, size.ones])
        net.threshold[:] = thresholds(out_of_half(rows, others))
    discarded(rows)
    give_back()
    return net


def out_of_half(rows: DataFrame, nets: list[Network]) -> DataFrame:
    """lang, logit and y of every row with a shard, by the network that did not learn from its half."""
    held = handed_out(rows.sparkSession, nets)

    def scan(batches):
        nets = taken_in(held)
        kernels = [net.kernels() for net in nets]
        for batch in small(batches, "words"):
            texts, _ = texts_of(batch)
            halves = (batch.column("shard").to_numpy() % HALVES).tolist()
            got = [nets[h].logit(words, stems, kernels[h]) for h, (words, stems, _) in zip(halves, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(got, pa.float64()), batch.column("y")], names=["lang", "logit", "y"])

    return rows.select("shard", "y", "lang", "words").mapInArrow(scan, "lang int, logit double, y int")


def _scores(net: Network, words: Vocabulary, texts: list[str | None]) -> list[float]:
    out, kernels = [], net.kernels()
    for t in texts:
        w, s, lang = words.of(t)
        out.append(net.score(net.logit(w, s, kernels), lang))
    return out


def scored(documents: DataFrame, net: Network, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every document.

    Only the text is an input; its language is recognised from function words.
    The whole text is convolved, in strides.  Null and empty texts get the score
    of a text without words; repeated rows are scored each; a null id stays null;
    an empty table gives no rows; other columns are ignored, whatever their names.
    """
    held = handed_out(documents.sparkSession, net)

    def scan(batches):
        net, words = taken_in(held), Vocabulary()
        for batch in small(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(net, words, batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, "doc_id long, score double")


def accepted(documents: DataFrame, net: Network, *, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of documents, all columns, whose score stays under limit; see scored()."""
    held, at = handed_out(documents.sparkSession, net), documents.columns.index(text)

    def keep(batches):
        net, words = taken_in(held), Vocabulary()
        for batch in small(batches, at):
            yield batch.filter(pa.array([s < limit for s in _scores(net, words, batch.column(at).to_pylist())], pa.bool_()))
        net = words = None
        give_back()

    return documents.mapInArrow(keep, documents.schema)


def op8_toxicity_cnn(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity; the fold crc32 mod 5 = 0 is held out from training."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    got = scored(docs, train(docs, labels))
    return got.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
