"""Classifiers of encoded sequences with Spark ML: training, prediction, search, learning curve."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target, keyword_only
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.operators.boosting import Boosted, fit_boosted
from readloom.operators.calibration import Calibration, calibration_error, reliability
from readloom.operators.counts import class_report, micro_recall
from readloom.operators.reads import shuffled
from readloom.sources.staging import materialize

_IO = {"featuresCol": "vector", "labelCol": "label"}


class KernelFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features of a vector column: their dot products approach the kernel exp(-gamma |x - y|^2), so that
    a linear classifier over them separates as that kernel does. The frequencies follow from the seed."""

    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "features made", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=0.1, size=256, seed=42):
        super().__init__()
        self._setDefault(gamma=0.1, size=256, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        gamma, size, seed = (self.getOrDefault(x) for x in ("gamma", "size", "seed"))

        @F.pandas_udf("array<double>")
        def made(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for xs in parts:
                x = np.stack(xs.to_list()) if len(xs) else np.zeros((0, 1))
                rng = np.random.default_rng(seed)
                w, shift = rng.normal(0, np.sqrt(2 * gamma), (x.shape[1], size)), rng.uniform(0, 2 * np.pi, size)
                yield pd.Series(list(np.sqrt(2 / size) * np.cos(x @ w + shift)))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(made(vector_to_array(self.getInputCol()))))


def classifier(kind: str = "forest", **params):
    """forest, tree, boosted (gradient-boosted trees, one class against the rest), logistic, bayes, svm (linear, one class
    against the rest) or rbf (the same over random Fourier features). fit() also knows joint: trees boosted over all
    classes at once."""
    makers = {
        "forest": lambda: RandomForestClassifier(**_IO, **{"numTrees": 100, "maxDepth": 20, "subsamplingRate": 0.3, "featureSubsetStrategy": "0.7", "seed": 42, **params}),
        "tree": lambda: DecisionTreeClassifier(**_IO, **{"maxDepth": 20, "seed": 42, **params}),
        "boosted": lambda: OneVsRest(**_IO, classifier=GBTClassifier(**_IO, **{"maxIter": 20, "maxDepth": 5, "stepSize": 0.3, "subsamplingRate": 0.3, "seed": 42, **params})),
        "logistic": lambda: LogisticRegression(**_IO, **{"family": "multinomial", **params}),
        "bayes": lambda: NaiveBayes(**_IO, **{"modelType": "multinomial", **params}),
        "svm": lambda: OneVsRest(**_IO, classifier=LinearSVC(**_IO, **params)),
        "rbf": lambda: OneVsRest(**{**_IO, "featuresCol": "kernel"}, classifier=LinearSVC(**{**_IO, "featuresCol": "kernel"}, **params)),
    }
    if kind not in makers:
        raise ValueError(f"classifier: one of {', '.join(makers)}")
    return makers[kind]()


def _vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vector", array_to_vector(F.coalesce(F.transform("features", lambda x: x.cast("double")), F.array(F.lit(0.0)))))


def _scale(train: DataFrame) -> float:
    """The kernel's usual width: 1 / (features times their variance)."""
    row = train.select(F.explode("features").alias("x")).agg(F.var_pop("x"), F.count("*")).first()
    size = train.agg(F.max(F.size("features"))).first()[0] or 1
    return 1 / (size * row[0]) if row[0] else 1.0


#: Rows of equal label and features that stay apart when trees learn: beyond, as many rows share the weight of all.
EQUAL_ROWS = 64


def _weighted(train: DataFrame, label: str) -> DataFrame:
    """(label, features, weight): equal rows as EQUAL_ROWS rows at most, whose weights add up to the number of rows.

    Trees keep all their rows in memory for each level, so reads of one sequence would else fill it over and over; enough
    rows remain for bootstraps to draw from.
    """
    equal = train.groupBy(label, "features").agg(F.count("*").alias("n"))
    shares = F.least("n", F.lit(EQUAL_ROWS)).cast("int")
    return equal.select(label, "features", (F.col("n") / shares).alias("weight"), F.explode(F.sequence(F.lit(1), shares)).alias("_share")).drop("_share")


def fit(train: DataFrame, kind: str = "forest", label: str = "species", **params) -> PipelineModel | Boosted:
    """Label index (alphabetical), classifier and names of predictions, for columns features and `label`.

    kind joint gives a Boosted model, which all functions here take too; rbf has the parameters gamma (by the features'
    variance unless given), size and seed of its kernel features beside those of the linear classifier. forest and tree
    learn from distinct rows with weights.
    """
    if kind == "joint":
        return fit_boosted(train, label, **params)
    if kind in ("forest", "tree"):
        train, params = materialize(_weighted(train, label), "weighted"), {"weightCol": "weight", **params}
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep").fit(train)
    names = IndexToString(inputCol="prediction", outputCol="predicted", labels=[*index.labels, "unknown"])
    kernel = []
    if kind == "rbf":
        own = {k: params.pop(k) for k in ("gamma", "size", "seed") if k in params}
        kernel = [KernelFeatures(inputCol="vector", outputCol="kernel", **{"gamma": own.get("gamma") or _scale(train), **{k: v for k, v in own.items() if k != "gamma"}})]
    return _without_summaries(Pipeline(stages=[index, *kernel, classifier(kind, **params), names]).fit(_vectors(train)))


def _without_summaries(model: PipelineModel) -> PipelineModel:
    """The model without its classifiers' training summaries. Those of two classes hold the session, which cannot travel
    to tasks with the model once a plan of the session has been observed (StageCounts)."""
    found = _classifier_of(model)
    for each in found.models if isinstance(found, OneVsRestModel) else [found]:
        if getattr(each, "hasSummary", False):
            each._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return model


def labels_of(model: PipelineModel | Boosted) -> list[str]:
    return list(model.labels if isinstance(model, Boosted) else model.stages[0].labels)


def _classifier_of(model: PipelineModel):
    return model.stages[-2]


def predict(model: PipelineModel | Boosted, df: DataFrame, calibration: Calibration | None = None) -> DataFrame:
    """df with prediction (index), predicted (name) and, where the classifier has them, probs; one pass of the model.

    Rows without features have no prediction and are left out. Boosted trees have one margin a class, which become
    probabilities by the logistic function and are scaled to a sum of one: flatter than a joint model's. With a
    calibration, probs, prediction and predicted are the calibrated ones.
    """
    if calibration is not None:
        return calibration.apply(predict(model, df))
    if isinstance(model, Boosted):
        return model.predict(df)
    scored = PipelineModel(model.stages[1:]).transform(_vectors(df.filter("features is not null"))).drop("vector", "kernel")
    if "probability" in scored.columns:
        scored = scored.withColumn("probs", vector_to_array("probability")).drop("probability")
    elif isinstance(_classifier_of(model), OneVsRestModel) and isinstance(_classifier_of(model).models[0], GBTClassificationModel):
        each = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        scored = scored.withColumn("_each", each).withColumn("probs", F.expr("transform(_each, p -> p / aggregate(_each, 0D, (a, x) -> a + x))")).drop("_each")
    return scored.drop("rawPrediction")


def save(model: PipelineModel | Boosted, path: str, calibration: Calibration | None = None) -> None:
    spark = SparkSession.active()
    if isinstance(model, Boosted):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)
    if calibration is not None:
        calibration.save(spark, path)


def train_and_save(sets: list[DataFrame], path: str, kind: str = "forest", rows: int | None = None, seed: int = 42, **params) -> PipelineModel:
    """Fit on the union of labelled sets (features, species), shuffled by a seeded hash, the first `rows` of them if
    given, and save the model."""
    every = reduce(DataFrame.unionByName, [s.select("features", "species") for s in sets])
    if rows is not None:
        every = shuffled(every.withColumn("_key", F.concat_ws(",", F.col("features").cast("array<string>"), "species")), "_key", seed).limit(rows).drop("_key")
    model = fit(every, kind, **params)
    save(model, path)
    return model


def report(model: PipelineModel, sets: dict[str, DataFrame], label: str = "species") -> DataFrame:
    """The class report of every set (train and test, say), with the set's name in the column `part`."""
    each = [class_report(predict(model, df), label, "predicted").withColumn("part", F.lit(name)) for name, df in sets.items()]
    return reduce(DataFrame.unionByName, each)


def load(path: str) -> PipelineModel | Boosted:
    spark = SparkSession.active()
    try:
        return Boosted.load(spark, path)
    except AnalysisException:
        return PipelineModel.load(path)


def load_calibration(path: str) -> Calibration | None:
    """The calibration saved with a model, if there is one."""
    try:
        return Calibration.load(SparkSession.active(), path)
    except AnalysisException:
        return None


def calibrated(model: PipelineModel | Boosted, held_out: DataFrame, label: str = "species") -> tuple[Calibration, DataFrame]:
    """A calibration fitted on rows that the model has not learnt from, and the error of each class before and after."""
    scored = materialize(predict(model, held_out).select(label, "prediction", "predicted", "probs"), "scored")
    labels = labels_of(model)
    found = Calibration.fit(scored, labels, label)
    parts = [calibration_error(reliability(df, labels, label)).withColumn("part", F.lit(part)) for part, df in (("before", scored), ("after", found.apply(scored)))]
    return found, reduce(DataFrame.unionByName, parts)


def importances(model: PipelineModel | Boosted) -> list[float]:
    if isinstance(model, Boosted):
        return (model.gains / max(model.gains.sum(), 1e-300)).tolist()
    return _classifier_of(model).featureImportances.toArray().tolist()


def recall(model: PipelineModel | Boosted, test: DataFrame, label: str = "species") -> float:
    return micro_recall(predict(model, test), label, "predicted").first()[0]


def _side_by_side(jobs: list[Callable[[], float]], parallelism: int) -> list[float]:
    """Results of the jobs in order, at most `parallelism` of them at a time in one session."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(lambda job: inheritable_thread_target(job)(), jobs))


def learning_curve(train: DataFrame, test: DataFrame, key: str, sizes: Iterable[float] = tuple(k / 10 for k in range(1, 11)), parallelism: int = 1, **params) -> list[tuple[int, float]]:
    """(rows, test recall) for growing parts of the training rows in seeded order, which are written once."""
    ordered = materialize(shuffled(train, key).withColumn("_n", F.monotonically_increasing_id()), "ordered")
    test, total = materialize(test, "test"), ordered.count()
    numbers = [max(1, round(total * s)) for s in sizes]
    jobs = [lambda n=n: recall(fit(ordered.orderBy("_n").limit(n).drop("_n"), **params), test) for n in numbers]
    return list(zip(numbers, _side_by_side(jobs, parallelism), strict=True))


def search(train: DataFrame, test: DataFrame, grid: dict[str, list], trials: int = 100, seed: int = 42, parallelism: int = 1, **params) -> tuple[dict, float]:
    """The best of random draws from a grid by test recall; the first wins ties. Both sets are written once; draws are
    fitted `parallelism` at a time, with the same result."""
    rng = random.Random(seed)
    drawn = [{k: rng.choice(v) for k, v in grid.items()} for _ in range(trials)]
    train, test = materialize(train, "train"), materialize(test, "test")
    scores = _side_by_side([lambda d=d: recall(fit(train, **params, **d), test) for d in drawn], parallelism)
    return max(zip(drawn, scores, strict=True), key=lambda x: x[1])


def plane(df: DataFrame) -> DataFrame:
    """df with xy, its first two principal components."""
    vectors = _vectors(df)
    pca = PCA(k=2, inputCol="vector", outputCol="_xy").fit(vectors)
    return pca.transform(vectors).withColumn("xy", vector_to_array("_xy")).drop("vector", "_xy")
