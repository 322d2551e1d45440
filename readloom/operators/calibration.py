"""Are predicted probabilities honest? Reliability by class, and isotonic calibration of each class."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of a class's probabilities whose counts the calibration is fitted on.
CELLS = 1000


def _by_class(scored: DataFrame, labels: list[str], label: str, probs: str, cells: int) -> DataFrame:
    """(k, cell, n, p, hits): rows by class and cell of the class's probability, their mean, and how many are of the class."""
    each = scored.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("_y"), F.posexplode(probs).alias("k", "p"))
    cell = F.least(F.floor(F.col("p") * cells), F.lit(cells - 1)).cast("int").alias("cell")
    own = F.get(F.array(*map(F.lit, labels)), F.col("k")) == F.col("_y")
    return each.groupBy("k", cell).agg(F.count("*").alias("n"), F.avg("p").alias("p"), F.count_if(own).alias("hits"))


def reliability(scored: DataFrame, labels: list[str], label: str = "species", probs: str = "probs", bins: int = 10) -> DataFrame:
    """(species, bin, n, mean_probability, share): of the rows whose probability for a class lies in a bin (0: lowest),
    the mean of that probability and the share that is of the class."""
    rows = _by_class(scored, labels, label, probs, bins)
    name = F.get(F.array(*map(F.lit, labels)), F.col("k")).alias("species")
    return rows.select(name, F.col("cell").alias("bin"), "n", F.col("p").alias("mean_probability"), (F.col("hits") / F.col("n")).alias("share"))


def calibration_error(table: DataFrame) -> DataFrame:
    """(species, error): mean distance of probability and share over the bins, weighted by their rows."""
    off = F.abs(F.col("mean_probability") - F.col("share")) * F.col("n")
    return table.groupBy("species").agg((F.sum(off) / F.sum("n")).alias("error"))


def pool(weight: np.ndarray, share: np.ndarray) -> list[tuple[int, float]]:
    """Least-squares rising steps by pooling neighbours that fall: (index of a step's first value, its level)."""
    steps: list[list[float]] = []
    for k, (w, s) in enumerate(zip(weight.tolist(), share.tolist(), strict=True)):
        steps.append([k, w, s])
        while len(steps) > 1 and steps[-2][2] >= steps[-1][2]:
            _, w2, s2 = steps.pop()
            w1, s1 = steps[-1][1:]
            steps[-1][1:] = [w1 + w2, (w1 * s1 + w2 * s2) / (w1 + w2)]
    return [(int(k), s) for k, _, s in steps]


@dataclass
class Calibration:
    """For each class rising steps: from a probability on, the calibrated one."""

    labels: list[str]
    steps: list[list[tuple[float, float]]]

    @classmethod
    def fit(cls, scored: DataFrame, labels: list[str], label: str = "species", probs: str = "probs", cells: int = CELLS) -> Calibration:
        """Fit on labelled rows that the model has not learnt from; counts by cell are all that the driver sees."""
        rows, steps = _by_class(scored, labels, label, probs, cells).collect(), []
        for k in range(len(labels)):
            own = sorted((r for r in rows if r.k == k), key=lambda r: r.cell)
            n, hits = (np.array([r[x] for r in own], float) for x in ("n", "hits"))
            steps.append([(own[at].cell / cells, level) for at, level in pool(n, hits / n)] if own else [(0.0, 0.0)])
        return cls(list(labels), steps)

    def _of(self, p: Column, k: int) -> Column:
        found = F.lit(self.steps[k][0][1])
        for start, level in self.steps[k][1:]:
            found = F.when(p >= start, level).otherwise(found)
        return found

    def apply(self, scored: DataFrame, probs: str = "probs") -> DataFrame:
        """scored with calibrated probs that sum to one, and prediction and predicted by them (ties: the first class).
        Rows for which every class has none keep their own."""
        each = F.array(*[self._of(F.get(probs, F.lit(k)), k) for k in range(len(self.labels))])
        df = scored.withColumn("_c", each).withColumn("_s", F.aggregate("_c", F.lit(0.0), lambda a, x: a + x))
        df = df.withColumn(probs, F.when(F.col("_s") > 0, F.transform("_c", lambda x: x / F.col("_s"))).otherwise(F.col(probs))).drop("_c", "_s")
        best = F.array_position(probs, F.array_max(probs)) - 1
        name = F.get(F.array(*map(F.lit, self.labels)), best.cast("int"))
        return df.withColumn("prediction", best.cast("double")).withColumn("predicted", name)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write beside a saved model."""
        spark.createDataFrame([(json.dumps([self.labels, self.steps]),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/calibration")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Calibration:
        labels, steps = json.loads(spark.read.text(f"{path}/calibration").first().value)
        return cls(labels, [[(a, b) for a, b in s] for s in steps])
