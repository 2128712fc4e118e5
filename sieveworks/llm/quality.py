"""Text quality by compression with dictionaries of good and of bad text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, handed_out, labelled_sample, read_table, small, taken_in

#: Bytes of each dictionary, the compression level, and the bytes of text compressed at once, so that a dictionary counts throughout a long text.
DICTIONARY_BYTES, LEVEL, BLOCK = 112_640, 3, 2048

#: Labelled documents of each class that training reads at most.
SAMPLE_PER_CLASS = 2500

#: The length of the pieces that the dictionaries are trained on; every sampled text is cut up whole.
PIECE = 1024


class CompressionClassifier:
    """Two dictionaries and a logistic calibration of what they save on a text."""

    def __init__(self, good: bytes = b"", bad: bytes = b""):
        self.good, self.bad = good, bad
        self.mean, self.std, self.weights = np.zeros(2), np.ones(2), np.zeros(3)

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        """Built anew in each worker: compressors don't travel."""
        return [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **({"dict_data": zstandard.ZstdCompressionDict(d)} if d else {})) for d in (self.good, self.bad)]

    @staticmethod
    def features(pair: list[zstandard.ZstdCompressor], text: str | None) -> tuple[float, float]:
        """The normalised difference of the two compressed sizes, and the logarithm of the better compression rate; zeros without text."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0, 0.0
        sizes = [sum(len(c.compress(raw[i : i + BLOCK])) for i in range(0, len(raw), BLOCK)) for c in pair]
        return (sizes[1] - sizes[0]) / (sizes[0] + sizes[1]), float(np.log(min(sizes) / len(raw)))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic regression by damped Newton steps, with a small ridge."""
        self.mean, self.std = x.mean(0), x.std(0) + 1e-9
        z = np.c_[(x - self.mean) / self.std, np.ones(len(x))]
        ridge = np.diag([1e-2, 1e-2, 1e-4])
        loss = lambda w: float((weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (z @ w))).sum() + w @ ridge @ w / 2)
        w = np.zeros(3)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(3), z.T @ (weight * (p - y)) + ridge @ w)
            size = 1.0
            while size > 1e-4 and loss(w - size * step) > loss(w):
                size /= 2
            w = w - size * step
            if np.abs(size * step).max() < 1e-6:
                break
        self.weights = w

    def score(self, pair: list[zstandard.ZstdCompressor], text: str | None) -> float:
        z = (np.array(self.features(pair, text)) - self.mean) / self.std
        return float(1 / (1 + np.exp(-np.clip(z @ self.weights[:2] + self.weights[2], -40, 40))))


def dictionary(texts: list[str]) -> bytes:
    """A trained zstandard dictionary of whole texts, or the distinct pieces themselves where they are too few or too alike to train on."""
    pieces: dict[bytes, None] = {}
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        pieces.update((raw[i : i + PIECE], None) for i in range(0, len(raw), PIECE))
    found = [p for p in pieces if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(found)


def train(documents: DataFrame, labels: DataFrame, *, label: str = "quality", fold: int = 4, held_out: int = 2, per_class: int = SAMPLE_PER_CLASS, doc_id: str = "doc_id", text: str = "text") -> CompressionClassifier:
    """Dictionaries from three fifths of the sample, the calibration from the rest, weighted to the classes' shares of all labels in use."""
    sample = labelled_sample(documents, labels, label=label, fold=fold, held_out=held_out, per_class=per_class, doc_id=doc_id, text=text)
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)").where(crc_mod("doc_id", fold) != held_out)
    shares = {r.y: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    build = np.array([xxhash.xxh3_64_intdigest(str(i)) % 5 < 3 for i, *_ in sample], bool)
    y = np.array([v for *_, v in sample], np.int64)
    model = CompressionClassifier(*(dictionary([t for (_, t, v), b in zip(sample, build, strict=True) if b and v == c]) for c in (1, 0)))
    if not len(y):
        return model
    held = np.flatnonzero(~build) if len(set(y[~build].tolist())) == 2 else np.arange(len(y))
    pair = model.compressors()
    x = np.array([model.features(pair, sample[i][1]) for i in held])
    yh = y[held]
    weight = np.ones(len(held))
    for c in (0, 1):
        own = yh == c
        if own.any():
            weight[own] = shares.get(c, 0) / max(1, sum(shares.values())) * len(held) / own.sum()
    model.fit(x, yh, weight)
    return model


def scored(documents: DataFrame, model: CompressionClassifier, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: better text) of every document.

    The whole text is compressed, in blocks.  Null and empty texts score as a
    text on which neither dictionary saves anything; without any usable label
    every score is 0.5.  Repeated rows are scored each; a null id stays null; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """
    held = handed_out(documents.sparkSession, model)

    def scan(batches):
        model = taken_in(held)
        pair = model.compressors()
        for batch in small(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(pair, t) for t in batch.column(1).to_pylist()], pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, "doc_id long, score double")


def op3_compression_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality; the fold crc32 mod 4 = 2 is held out from training."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    got = scored(docs, train(docs, labels))
    return got.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
