"""Gradient-boosted trees over all classes at once: softmax gradients, histograms of small integer features.

A round grows one tree a class, level by level. For a level every task sums gradients and hessians of its rows by
(class, node, feature, bin) with numpy; Spark adds the tasks' sums in one aggregation, whose size depends on classes,
nodes, features and bins alone, and the driver picks each node's best split. Rows never leave their tasks; their margins
are written to the shared folder every STAGED rounds, so a task repeats that many rounds of trees at most.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.sources.staging import materialize

STAGED = 8
_SEED = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tree:
    """A binary tree in heap order: node k has children 2k + 1 (bin at most `cut`) and 2k + 2; feature -1: a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node in which each row of x stops."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            f = self.feature[at]
            goes = f >= 0
            if not goes.any():
                return at
            right = x[rows, np.maximum(f, 0)] > self.cut[at]
            at = np.where(goes, 2 * at + 1 + right, at)


@dataclass
class Boosted:
    """A trained model; `trees` has a list of one tree a class for each round, values scaled by the learning rate."""

    labels: list[str]
    n_features: int
    trees: list[list[Tree]] = field(default_factory=list)
    gains: np.ndarray | None = None

    def margins(self, x: np.ndarray, rounds: slice = slice(None)) -> np.ndarray:
        out = np.zeros((len(x), len(self.labels)))
        for one in self.trees[rounds]:
            for k, tree in enumerate(one):
                out[:, k] += tree.value[tree.nodes(x)]
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """df with prediction (index), predicted (name) and probs; rows without features are left out."""
        kept = df.filter("features is not null").drop("prediction", "predicted", "probs")
        names = [f"c{k}" for k in range(len(kept.columns))]
        made = [T.StructField("prediction", T.DoubleType()), T.StructField("predicted", T.StringType()), T.StructField("probs", T.ArrayType(T.DoubleType()))]
        schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(names, kept.schema.fields, strict=True)), *made])
        at = kept.columns.index("features")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                p = softmax(self.margins(matrix(b.column(at), self.n_features)))
                best = p.argmax(1)
                cols = [pa.array(best.astype(float)), pa.array([self.labels[k] for k in best], pa.string()), pa.array(list(p), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*names, "prediction", "predicted", "probs"])

        return kept.toDF(*names).mapInArrow(run, schema).toDF(*kept.columns, "prediction", "predicted", "probs")

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [[[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in one] for one in self.trees]
        text = json.dumps({"labels": self.labels, "n_features": self.n_features, "trees": trees, "gains": self.gains.tolist()})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/boosted")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        held = json.loads(spark.read.text(f"{path}/boosted").first().value)
        trees = [[Tree(np.array(f), np.array(c), np.array(v)) for f, c, v in one] for one in held["trees"]]
        return cls(held["labels"], held["n_features"], trees, np.array(held["gains"]))


def matrix(column: pa.Array, n: int) -> np.ndarray:
    """Rows of n small integers; longer features are cut, shorter ones and nulls filled with 0."""
    out = np.zeros((len(column), n), np.uint8)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.nan_to_num(np.asarray(column.value_lengths().fill_null(0))))
    size = np.diff(np.r_[0, ends]).astype(np.int64)
    row = np.repeat(np.arange(len(column)), size)
    place = np.arange(len(flat)) - np.repeat(ends.astype(np.int64) - size, size)
    ok = place < n
    out[row[ok], place[ok]] = np.nan_to_num(flat[ok]).astype(np.uint8)
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = softmax(margins)
    hessian = np.maximum(2 * p * (1 - p), 1e-16)
    p[np.arange(len(label)), label] -= 1
    return p, hessian


def sampled(rid: np.ndarray, turn: int, share: float, seed: int) -> np.ndarray:
    """Which rows take part in a round, by a hash of their number."""
    h = (rid.astype(np.uint64) + np.uint64(seed * 1_000_003 + turn + 1)) * _SEED
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(11)).astype(float) / (1 << 53) < share


def level_sums(x: np.ndarray, g: np.ndarray, h: np.ndarray, trees: list[Tree], level: int, bins: int) -> np.ndarray:
    """Sums of g and h by (class, node of the level, feature, bin): an array of that shape, times two."""
    width, n_features = 1 << level, x.shape[1]
    out = np.zeros((len(trees), width, n_features, bins, 2))
    cell = np.arange(n_features) * bins + x
    for k, tree in enumerate(trees):
        node = tree.nodes(x) - (width - 1)
        at = np.flatnonzero(node >= 0)
        flat = (node[at, None] * (n_features * bins) + cell[at]).ravel()
        for j, v in enumerate((g, h)):
            out[k, ..., j] = np.bincount(flat, np.repeat(v[at, k], n_features), width * n_features * bins).reshape(width, n_features, bins)
    return out


def grow(tree: Tree, sums: np.ndarray, level: int, columns: np.ndarray, rate: float, penalty: float, least: float, last: bool, gains: np.ndarray) -> None:
    """Split the nodes of a level where that gains, by sums (node, feature, bin, 2), and set the values of the others."""
    for node in range(1 << level):
        at = (1 << level) - 1 + node
        if level and (tree.feature[(at - 1) // 2] < 0):
            continue
        total = sums[node, 0].sum(0)
        tree.value[at] = -rate * total[0] / (total[1] + penalty)
        if last:
            continue
        left = sums[node].cumsum(1)[:, :-1]
        right = total - left
        score = lambda s: s[..., 0] ** 2 / (s[..., 1] + penalty)
        gain = score(left) + score(right) - score(total)
        gain[(left[..., 1] < least) | (right[..., 1] < least)] = -np.inf
        gain[~columns] = -np.inf
        best = int(gain.argmax())
        if gain.flat[best] > 1e-9:
            tree.feature[at], tree.cut[at] = divmod(best, gain.shape[1])
            gains[tree.feature[at]] += gain.flat[best]


def fit_boosted(
    train: DataFrame, label: str = "species", rounds: int = 20, depth: int = 5, rate: float = 0.3, subsample: float = 0.3,
    columns: float = 0.7, penalty: float = 1.0, least: float = 1.0, bins: int = 5, seed: int = 42,
) -> Boosted:
    """Train on features (arrays of integers from 0 below bins) and `label`; rows with a null in either are left out.

    subsample and columns are the shares of rows a round and of features a tree; penalty is added to hessian sums, least
    is the hessian that a child needs.
    """
    rows = train.filter(F.col(label).isNotNull() & F.col("features").isNotNull())
    names = sorted(r[0] for r in rows.select(F.col(label).cast("string")).distinct().collect())
    widest = rows.agg(F.max(F.size("features"))).first()[0] or 0
    if not names:
        raise ValueError("no labelled rows with features")
    place = F.array_position(F.array(*map(F.lit, names)), F.col(label).cast("string")).cast("int") - 1
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "features", place.alias("y"), F.array_repeat(F.lit(0.0), len(names)).alias("margins"))
    rows, model, staged = materialize(rows, "boosting"), Boosted(names, widest), 0
    model.gains = np.zeros(widest)
    rng = np.random.default_rng(seed)
    for turn in range(rounds):
        chosen = np.zeros((len(names), widest), bool)
        for one in chosen:
            one[rng.permutation(widest)[: max(1, round(columns * widest))]] = True
        trees = [Tree.empty(depth) for _ in names]
        for level in range(depth + 1):
            sums = _summed(rows, model, staged, trees, level, bins, turn, subsample, seed)
            for k, tree in enumerate(trees):
                grow(tree, sums[k], level, chosen[k], rate, penalty, least, level == depth, model.gains)
        model.trees.append(trees)
        if len(model.trees) - staged == STAGED and turn < rounds - 1:
            rows, staged = materialize(_advanced(rows, model, staged), "boosting"), len(model.trees)
    return model


def _margins(b: pa.RecordBatch, model: Boosted, staged: int) -> tuple[np.ndarray, np.ndarray]:
    x = matrix(b.column(1), model.n_features)
    held = b.column(3).flatten().to_numpy().reshape(len(x), len(model.labels))
    return x, held + model.margins(x, slice(staged, None))


def _advanced(rows: DataFrame, model: Boosted, staged: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, m = _margins(b, model, staged)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(list(m), pa.list_(pa.float64()))], names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def _summed(rows: DataFrame, model: Boosted, staged: int, trees: list[Tree], level: int, bins: int, turn: int, subsample: float, seed: int) -> np.ndarray:
    """level_sums over all rows, added up by Spark."""
    shape = (len(trees), 1 << level, model.n_features, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*shape, 2))
        for b in batches:
            x, m = _margins(b, model, staged)
            keep = sampled(b.column(0).to_numpy(), turn, subsample, seed)
            g, h = gradients(m, b.column(2).to_numpy())
            total += level_sums(x[keep], g[keep], h[keep], trees, level, bins)
        flat = total.reshape(-1, 2)
        at = np.flatnonzero(flat.any(1))
        for lo in range(0, len(at), 1 << 16):
            some = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some, 0]), pa.array(flat[some, 1])], names=["cell", "g", "h"])

    added = rows.mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    out = np.zeros((*shape, 2))
    out.reshape(-1, 2)[added["cell"].to_numpy()] = np.stack([added["g"].to_numpy(), added["h"].to_numpy()], 1)
    return out
