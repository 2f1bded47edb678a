"""Classifiers, clusters, topics and projections by ``pyspark.ml``; one table has the results of any number of models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.feature import PCA, CountVectorizer, HashingTF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from .learners import MixedLinear, SecondOrderBoosting

ON = {"featuresCol": "features", "labelCol": "label"}
#: Estimators by name.  Regressions learn -1 and 1 and predict by the sign.
MODELS = {
    "logistic_regression": lambda seed: LogisticRegression(maxIter=1000, **ON),
    "decision_tree": lambda seed: DecisionTreeClassifier(seed=seed, **ON),
    "random_forest": lambda seed: RandomForestClassifier(seed=seed, **ON),
    "gradient_boosting": lambda seed: GBTClassifier(seed=seed, **ON),
    "x_gradient_boosting": lambda seed: SecondOrderBoosting(**ON),
    "support_vector_machine": lambda seed: LinearSVC(regParam=0.01, **ON),
    "perceptron": lambda seed: MixedLinear(kind="perceptron", **ON),
    "sgd": lambda seed: MixedLinear(kind="hinge", **ON),
    "ridge": lambda seed: LinearRegression(regParam=1.0, elasticNetParam=0.0, featuresCol="features", labelCol="sign"),
    "linear_regression": lambda seed: LinearRegression(featuresCol="features", labelCol="sign"),
    "elastic_net": lambda seed: LinearRegression(regParam=0.01, elasticNetParam=0.5, featuresCol="features", labelCol="sign"),
}


def model(name: str, seed: int = 42) -> Estimator:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(MODELS)}")
    return MODELS[name](seed)


def features(df: DataFrame, vector: str, label: str | None = None) -> DataFrame:
    """Adds ``features``, and with a label ``label`` (0 or 1) and ``sign``."""
    out = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    return out if label is None else out.withColumns({"label": F.col(label).cast("double"), "sign": F.col(label).cast("double") * 2 - 1})


def train_all(rows: DataFrame, names: list[str], seed: int = 42) -> dict[str, PipelineModel]:
    return {n: Pipeline(stages=[model(n, seed)]).fit(rows) for n in names}


def predict_all(rows: DataFrame, fitted: dict[str, PipelineModel], keep: list[str]) -> DataFrame:
    """``keep`` and a column of 0 and 1 for each model, in one pass over the rows."""
    made = ("prediction", "rawPrediction", "probability")
    out = rows
    for name, m in fitted.items():
        hard = F.col("prediction") > (0.0 if isinstance(m.stages[0], tuple(_regressions())) else 0.5)
        out = m.transform(out).withColumn(name, hard.cast("int")).drop(*made)
    return out.select(*keep, *fitted)


def _regressions():
    from pyspark.ml.regression import LinearRegressionModel

    return [LinearRegressionModel]


def save_all(fitted: dict[str, PipelineModel], folder: str) -> None:
    for name, m in fitted.items():
        m.write().overwrite().save(f"{folder}/{name}")


def load_all(folder: str, names: list[str] | None = None) -> dict[str, PipelineModel]:
    """The named models of a folder; all that are there, by name, if none are named."""
    if names is None:
        spark = SparkSession.active()
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder)
        place = F.regexp_extract("path", r"/([^/]+)/metadata/part-", 1)
        names = sorted(r.n for r in files.where(place.isin(*MODELS)).select(place.alias("n")).distinct().collect())
    return {n: PipelineModel.load(f"{folder}/{n}") for n in names}


def cross_validated(rows: DataFrame, name: str, id_col: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """``fold, n, accuracy``: rows are dealt by the hash of their id, each fold is predicted by the others' model."""
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(folds)).cast("int"))
    parts = []
    for k in range(folds):
        fitted = train_all(dealt.where(F.col("fold") != k), [name], seed)
        parts.append(predict_all(dealt.where(F.col("fold") == k), fitted, ["fold", "label"]))
    hit = (F.col(name) == F.col("label")).cast("double")
    return reduce(DataFrame.unionByName, parts).groupBy("fold").agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def clusters(rows: DataFrame, k: int, seed: int = 0, mixture: bool = False) -> DataFrame:
    """Adds ``cluster``, by k-means or a mixture of Gaussians."""
    made = (GaussianMixture if mixture else KMeans)(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows).transform(rows)
    return made.drop("probability") if mixture else made


def slices(clustered: DataFrame, names: list) -> dict[object, DataFrame]:
    """Each named cluster's rows; null names those without a cluster.  ``reduce(DataFrame.unionByName, ...)`` puts them together again."""
    return {n: clustered.where(F.col("cluster").eqNullSafe(F.lit(n))) for n in names}


def centroids(clustered: DataFrame, vector: str) -> DataFrame:
    """``cluster, n, centroid``: means by place."""
    placed = clustered.select("cluster", F.posexplode(vector).alias("place", "x")).groupBy("cluster", "place").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    return placed.groupBy("cluster").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("centroid"))


def projected(rows: DataFrame, k: int = 2) -> DataFrame:
    """Adds ``projected``, the first ``k`` principal components as an array."""
    made = PCA(k=k, inputCol="features", outputCol="_p").fit(rows).transform(rows)
    return made.withColumn("projected", vector_to_array("_p")).drop("_p")


def topics(docs: DataFrame, text: str, k: int = 2, passes: int = 15, vocabulary: int | None = None, seed: int = 42) -> DataFrame:
    """Adds ``topics``, each document's share of each topic.

    Each term has a place of its own; with ``vocabulary`` terms are hashed to so many places, so that none is dropped.
    """
    bags = docs.withColumn("_t", tokens(F.lower(text)))
    if vocabulary is None:
        n = max(1, bags.select(F.explode("_t").alias("t")).agg(F.count_distinct("t")).first()[0])
        counted = CountVectorizer(inputCol="_t", outputCol="features", vocabSize=n).fit(bags).transform(bags)
    else:
        counted = HashingTF(inputCol="_t", outputCol="features", numFeatures=vocabulary).transform(bags)
    made = LDA(k=k, maxIter=passes, seed=seed, topicDistributionCol="_d").fit(counted).transform(counted)
    return made.withColumn("topics", vector_to_array("_d")).drop("_t", "_d", "features")
