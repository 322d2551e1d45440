"""Joint boosting against plain rounds, calibration, kernels and searches side by side."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.operators import boosting, calibration, models
from readloom.operators.reads import StageCounts


def labelled(spark, n=400, width=12, seed=2):
    """Three classes that depend on pairs of features, and one row without features."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.randrange(5) for _ in range(width)]
        y = (x[0] > 2) + (x[1] > 2 and x[2] < 2) if rng.random() < 0.95 else rng.randrange(3)
        rows.append((x, "abc"[y]))
    return spark.createDataFrame([*rows, (None, "a"), ([1] * width, None)], "features array<int>, species string").repartition(3), rows


def plain_round(x, y, margins, n_classes, depth, rate, penalty, least):
    """One round of trees by loops over rows: (new margins)."""
    p = np.exp(margins - margins.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    out = margins.copy()
    for k in range(n_classes):
        g, h = p[:, k] - (y == k), np.maximum(2 * p[:, k] * (1 - p[:, k]), 1e-16)

        def build(rows, level, k=k, g=g, h=h):
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-9, None)
            if level < depth:
                for f in range(x.shape[1]):
                    for cut in range(4):
                        left = rows[x[rows, f] <= cut]
                        gl, hl = g[left].sum(), h[left].sum()
                        gr, hr = gs - gl, hs - hl
                        if hl >= least and hr >= least:
                            gain = gl * gl / (hl + penalty) + gr * gr / (hr + penalty) - gs * gs / (hs + penalty)
                            if gain > best[0] + 1e-9:
                                best = (gain, (f, cut))
            if best[1] is None:
                out[rows, k] += -rate * gs / (hs + penalty)
                return
            f, cut = best[1]
            build(rows[x[rows, f] <= cut], level + 1)
            build(rows[x[rows, f] > cut], level + 1)

        build(np.arange(len(x)), 0)
    return out


def test_rounds_equal_plain_ones(spark):
    df, rows = labelled(spark, 150, 6)
    model = boosting.fit_boosted(df, rounds=10, depth=3, subsample=1.0, columns=1.0)
    x, y = np.array([r[0] for r in rows]), np.array(["abc".index(r[1]) for r in rows])
    y_rows = np.array([r[1] for r in rows])
    assert model.labels == ["a", "b", "c"]
    # The row of ones without a label takes no part; margins start at zero.
    margins = np.zeros((len(x), 3))
    for n in range(1, 11):
        margins = plain_round(x, y, margins, 3, 3, 0.3, 1.0, 1.0)
        assert np.allclose(model.margins(x.astype(np.uint8), slice(0, n)), margins), n
    assert (np.array(list("abc"))[margins.argmax(1)] == y_rows).mean() > 0.8


def test_joint_model(spark, tmp_path):
    df, _ = labelled(spark, 900)
    train, test = df.filter(F.pmod(F.xxhash64("features"), F.lit(3)) > 0), df.filter(F.pmod(F.xxhash64("features"), F.lit(3)) == 0)
    model = models.fit(train, "joint", rounds=15, depth=4, subsample=0.8)
    forest = models.fit(train, numTrees=15, maxDepth=6)

    def loss(m):
        rows = models.predict(m, test.filter("species is not null")).collect()
        return np.mean([-math.log(max(1e-9, r.probs["abc".index(r.species)])) for r in rows]), len(rows)

    (own, n), (other, n2) = loss(model), loss(forest)
    assert own <= other and n == n2 == test.filter("features is not null and species is not null").count()
    assert models.recall(model, test.filter("species is not null")) > 0.85 and sum(models.importances(model)) == pytest.approx(1)
    assert np.argsort(models.importances(model))[-3:].tolist() in [list(p) for p in ([0, 1, 2], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1], [2, 1, 0])]
    cal, errors = models.calibrated(model, test.filter("species is not null"))
    models.save(model, f"{tmp_path}/m", cal)
    back, cal2 = models.load(f"{tmp_path}/m"), models.load_calibration(f"{tmp_path}/m")
    assert cal2 == cal and models.load_calibration(f"{tmp_path}/none") is None
    one, two = ([(tuple(r.features), r.predicted, r.probs) for r in sorted(models.predict(m, test, c).collect(), key=lambda r: r.features)] for m, c in ((model, cal), (back, cal2)))
    assert one == two and all(sum(p) == pytest.approx(1) for *_, p in one)
    rows = {(r.species, r.part): r.error for r in errors.collect()}
    assert all(rows[c, "after"] <= rows[c, "before"] + 0.02 for c in "abc")


def test_short_long_and_missing_features(spark):
    df = spark.createDataFrame([([1, 2], "x"), ([3], "y"), ([3, 0, 0], "y"), ([], "x"), ([1, None], "x")] * 6, "features array<int>, species string")
    model = models.fit(df, "joint", rounds=3, depth=2, subsample=1.0, columns=1.0, least=0.1)
    got = {tuple(r.features): r.predicted for r in models.predict(model, df.withColumn("c1", F.lit(1))).collect()}
    assert got[(3,)] == got[(3, 0, 0)] == "y" and got[(1, 2)] == got[()] == "x"
    with pytest.raises(ValueError):
        models.fit(df.limit(0), "joint")


def plain_rising(w, s):
    """The best rising fit by the max-min formula."""
    mean = lambda i, j: np.average(s[i : j + 1], weights=w[i : j + 1])
    n = len(s)
    return [max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]


def test_pooled_steps():
    rng = np.random.default_rng(1)
    for _ in range(40):
        n = int(rng.integers(1, 14))
        w, s = rng.integers(1, 9, n).astype(float), rng.random(n).round(1)
        steps = calibration.pool(w, s)
        got = [next(v for at, v in reversed(steps) if at <= k) for k in range(n)]
        assert np.allclose(got, plain_rising(w, s))


def test_calibration_mends_overconfidence(spark):
    """Probabilities of 0.95 that are right in 60 % of cases, and 0.6 in 58 %."""
    rng = random.Random(7)
    rows = []
    for _ in range(2000):
        p, right = rng.choice(((0.95, 0.6), (0.6, 0.58)))
        rows.append(("a" if rng.random() < right else "b", [p, 1 - p], 0.0, "a"))
    scored = spark.createDataFrame(rows, "species string, probs array<double>, prediction double, predicted string")
    found = calibration.Calibration.fit(scored, ["a", "b"])
    after = found.apply(scored)
    assert all(0.53 < r.probs[0] < 0.65 for r in after.collect())
    before, later = (calibration.calibration_error(calibration.reliability(df, ["a", "b"])).agg(F.max("error")).first()[0] for df in (scored, after))
    assert before > 0.15 and later < 0.03
    bins = {r.bin: r for r in calibration.reliability(scored, ["a", "b"]).filter("species = 'a'").collect()}
    assert bins.keys() == {6, 9} and sum(r.n for r in bins.values()) == 2000 and bins[9].mean_probability == pytest.approx(0.95)


def test_kernel_separates_a_ring(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        a, r = rng.random() * 2 * math.pi, rng.choice((1.0, 3.0))
        r += rng.gauss(0, 0.2)
        rows.append(([r * math.cos(a), r * math.sin(a)], "in" if abs(r) < 2 else "out"))
    df = spark.createDataFrame(rows, "features array<double>, species string")
    linear, ring = models.fit(df, "svm", maxIter=20), models.fit(df, "rbf", maxIter=30, size=128)
    assert models.recall(linear, df) < 0.75 and models.recall(ring, df) > 0.97
    models.save(ring, f"{tmp_path}/ring")
    assert models.recall(models.load(f"{tmp_path}/ring"), df) == models.recall(ring, df)


@pytest.mark.parametrize("kind", ["svm", "logistic", "forest"])
def test_models_travel_after_an_observed_plan(spark, kind):
    seen = StageCounts()
    assert seen.watch(spark.range(5), "all").count() == 5 and seen.rows() == [("all", 5, 0)]
    for labels in ("ab", "a"):
        df = spark.createDataFrame([([k % 2, k % 3], labels[k % len(labels)]) for k in range(40)], "features array<int>, species string")
        if kind == "svm" and labels == "a":
            continue
        model = models.fit(df, kind, **({"numTrees": 3} if kind == "forest" else {"maxIter": 5}))
        assert models.predict(model, df).filter("predicted = species").count() == 40


def test_searches_side_by_side(spark):
    df, _ = labelled(spark, 200, 5)
    df = df.filter("features is not null and species is not null").withColumn("k", F.xxhash64("features", "species"))
    grid = {"numTrees": [1, 3, 5], "maxDepth": [1, 4]}
    one, many = (models.search(df, df, grid, trials=4, parallelism=n, subsamplingRate=1.0) for n in (1, 3))
    assert one == many
    curves = [models.learning_curve(df, df, "k", (0.3, 1.0), parallelism=n, kind="tree", maxDepth=3) for n in (1, 2)]
    assert curves[0] == curves[1] and [n for n, _ in curves[0]] == [60, 200]


def test_equal_rows_share_their_weight(spark):
    """Trees learn from a bounded number of rows of one content, whose weights add up to all of them."""
    rows = [("a", [1, 0])] * 1000 + [("b", [0, 1])] * 10 + [("b", [0, 2])]
    train = spark.createDataFrame(rows, "species string, features array<int>")
    weighted = models._weighted(train, "species")
    got = {(r.species, tuple(r.features)): (r.n, r.w) for r in weighted.groupBy("species", "features").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert got == {("a", (1, 0)): (64, 1000.0), ("b", (0, 1)): (10, 10.0), ("b", (0, 2)): (1, 1.0)}
    model = models.fit(train, numTrees=5, maxDepth=3)
    assert models.predict(model, train).filter("species <> predicted").count() == 0
