"""Quality classifier with supervised subword embeddings (operator 7).

A document is the mean of learned vectors of its hashed words and character n-grams; a softmax over that mean gives
its class. numpy trains vectors and softmax by stochastic gradient descent on at most `train_rows` labelled rows, the
ones whose ids hash lowest. The model is linear in the features, so scoring reduces each feature to one number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.common import give_back, materialize, places, ship, table, with_columns

BUCKETS = 1 << 17
GRAMS = (3, 4)
#: Bucket of the repeated-word feature, past the hashed ones.
AGAIN = BUCKETS
#: Bound on the labelled rows that the classifier learns from.
TRAIN_ROWS = 4000
#: Bound on the bytes of their texts: rows beyond it, in order of their ids' hashes, are not learnt from.
TRAIN_BYTES = 64 << 20
#: Bytes of texts whose words are hashed together.
GROUP_BYTES = 1 << 20


def features_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, place of its word in the list) of every word and of the n-grams of its characters between < and >."""
    edged = [f"<{w.decode('utf-8', 'replace')}>" for w in words]
    chars = np.frombuffer("".join(edged).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, edged), np.int64, len(edged))
    end = np.repeat(np.cumsum(size), size)
    owner = np.repeat(np.arange(len(words)), size)
    buckets, owners = [np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (BUCKETS - 1)], [np.arange(len(words))]
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(chars)) + n <= end)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ chars[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        buckets.append((h >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1))
        owners.append(owner[at])
    return np.concatenate(buckets), np.concatenate(owners)


def repeats(words: list[bytes]) -> int:
    """How many words equal the word before; each counts as one more feature, with a learned vector of its own."""
    return sum(map(eq, words, words[1:]))


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    total = np.zeros(BUCKETS + 1, np.int64)
    words = text.split()
    count = Counter(words)
    bucket, owner = features_of(list(count))
    np.add.at(total, bucket, np.fromiter(count.values(), np.int64, len(count))[owner])
    total[AGAIN] += repeats(words)
    at = np.flatnonzero(total)
    return at, total[at] / max(1, total.sum())


class SubwordModel:
    """Vectors by bucket and a softmax over two classes."""

    def __init__(self, dim: int = 16, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS + 1, dim))
        self.weights, self.bias = np.zeros((2, dim)), np.zeros(2)
        self.rng = rng

    def probabilities(self, at: np.ndarray, share: np.ndarray) -> np.ndarray:
        z = self.weights @ (share @ self.vectors[at]) + self.bias
        e = np.exp(z - z.max())
        return e / e.sum()

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.5) -> SubwordModel:
        step, steps = 0, max(1, epochs * len(rows))
        for _ in range(epochs):
            for k in self.rng.permutation(len(rows)).tolist():
                at, share, label = rows[k]
                mean = share @ self.vectors[at]
                z = self.weights @ mean + self.bias
                e = np.exp(z - z.max())
                error = e / e.sum()
                error[label] -= 1
                lr = rate * (1 - step / steps)
                back = self.weights.T @ error
                self.weights -= lr * np.outer(error, mean)
                self.bias -= lr * 0.1 * error
                # Mean features are small shares; the vectors' step is scaled to the number of distinct features.
                self.vectors[at] -= lr * min(len(at), 400) * share[:, None] * back
                step += 1
        return self

    def flat(self) -> tuple[np.ndarray, float]:
        """Each bucket's contribution to the log odds of class 1, and the log odds of an empty text."""
        return self.vectors @ (self.weights[1] - self.weights[0]), float(self.bias[1] - self.bias[0])


def fold(doc_id: str) -> F.Column:
    """Remainder of crc32 of the id as text; null ids have none."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, label: str, train_rows: int = TRAIN_ROWS) -> SubwordModel:
    """Fit on labelled rows whose fold is not 1; at most train_rows of them, those of lowest hash. No rows: no opinion."""
    ship(docs.sparkSession)
    ids = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)")
    ids = ids.groupBy("_id").agg(F.max("_y").alias("_y")).filter(fold("_id") != 1)
    ids = materialize(ids.orderBy(F.xxhash64("_id"), "_id").limit(train_rows), "ids")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_t")).join(F.broadcast(ids), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t, y in zip(b.column(0), b.column(1), b.column(2), strict=True):
                at, share = text_features(t.as_py() or b"")
                steps = np.diff(at.astype("<i4"), prepend=np.zeros(1, "<i4"))
                cols = [pa.array([i.as_py()]), pa.array([y.as_py()], pa.int32()), *(pa.array([zlib.compress(x, 1)]) for x in (steps.tobytes(), share.astype("<f4").tobytes()))]
                yield pa.RecordBatch.from_arrays(cols, names=["_id", "_y", "at", "share"])

    # Of rows with one id the first by content stands, so that their number is bounded, whatever repeats.
    one = texts.groupBy(F.col("_id").cast("long").alias("_id"), "_y").agg(F.min("_t").alias("_t"))
    size = F.sum(F.coalesce(F.octet_length("_t"), F.lit(0))).over(Window.orderBy(F.xxhash64("_id"), "_id"))
    one = materialize(one.withColumn("_upto", size).filter(F.col("_upto") <= TRAIN_BYTES).select("_id", "_t", "_y"), "rows")
    learnt = []
    for r in one.mapInArrow(run, "_id long, _y int, at binary, share binary").toLocalIterator():
        steps, share = (np.frombuffer(zlib.decompress(r[k]), kind) for k, kind in (("at", "<i4"), ("share", "<f4")))
        learnt.append((r["_id"], np.cumsum(steps, dtype=np.int32), share, r["_y"]))
    learnt.sort(key=lambda x: x[0])
    model = SubwordModel().fit([x[1:] for x in learnt])
    del learnt
    give_back()
    return model


def _groups(texts: pa.Array) -> Iterator[list[bytes]]:
    """Texts by about GROUP_BYTES; a longer one stands alone."""
    held, size = [], 0
    for t in texts:
        value = t.as_py() or b""
        if held and size + len(value) > GROUP_BYTES:
            yield held
            held, size = [], 0
        held.append(value)
        size += len(value)
    if held:
        yield held


def score(docs: DataFrame, model: SubwordModel, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a double column `out`: the probability of class 1. Null and blank texts get the prior's."""
    spark = docs.sparkSession
    ship(spark)
    flat = spark.sparkContext.broadcast(model.flat())
    kept, made = docs.drop(out), [T.StructField(out, T.DoubleType())]
    names, at = places(kept, made), kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        weights, prior = flat.value
        again = complex(weights[AGAIN], 1)
        for b in batches:
            logits = []
            for texts in _groups(b.column(at).cast(pa.binary())):
                split = [t.split() for t in texts]
                every = list(set(chain.from_iterable(split)))
                bucket, owner = features_of(every)
                sums = np.bincount(owner, weights[bucket], len(every)) + 1j * np.bincount(owner, minlength=len(every))
                # A word stands for its features' sum and number, as one complex number.
                words = dict(zip(every, sums.tolist(), strict=True))
                for x in split:
                    total = sum(map(words.__getitem__, x), again * repeats(x))
                    logits.append(prior + (total.real / total.imag if total.imag else 0.0))
            p = 1 / (1 + np.exp(-np.clip(logits, -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=names)

    return with_columns(kept, made, run)


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (probability of label 1), predicted (1 from 0.5 on).

    Learns from labels whose id's fold is not 1; only texts are inputs. Null ids are not held out and not learnt from;
    null or other labels are ignored; of repeated labels the larger counts; repeated rows are scored each.
    """
    model = train(docs, labels, text, doc_id, label, train_rows)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t"))
    scored = score(rows, model, "_t").drop("_t")
    held = F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
