"""Model pipelines on MLlib: preprocessing, baselines, boosted trees, reports."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.typing import model_columns


def cleaned(rows: DataFrame, numeric: list[str], categorical: list[str], *keep: str) -> DataFrame:
    """Features in model types: not finite becomes null, null categories a word of their own."""
    typed = rows.select(*keep, *model_columns(categorical, numeric))
    finite = {c: F.when(~(F.isnan(c) | (F.abs(F.col(c)) == float("inf"))), F.col(c)) for c in numeric}
    return typed.withColumns(finite | {c: F.coalesce(F.trim(c), F.lit("__MISSING__")) for c in categorical})


def preprocessing(numeric: list[str], categorical: list[str]) -> list:
    """Median for nulls, standard scale; one-hot categories, unknown ones all zero."""
    return [
        Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric]),
        VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="_numbers"),
        StandardScaler(withMean=True, inputCol="_numbers", outputCol="_scaled"),
        StringIndexer(inputCols=categorical, outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_hot" for c in categorical], handleInvalid="keep"),
        VectorAssembler(inputCols=["_scaled", *(f"{c}_hot" for c in categorical)], outputCol="features"),
    ]


def balanced(rows: DataFrame, label: str) -> DataFrame:
    """Adds class weights n / (2 n_class)."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for value, k in counts.items():
        weight = F.when(F.col(label) == value, n / (len(counts) * k)).otherwise(weight)
    return rows.withColumn("_weight", weight)


def positive_weighted(rows: DataFrame, label: str) -> DataFrame:
    """Adds a weight of negatives / positives for positives and 1 for others."""
    n, positives = rows.agg(F.count("*"), F.sum(F.col(label).cast("long"))).head()
    return rows.withColumn("_weight", F.when(F.col(label) == 1, (n - positives) / max(1, positives or 0)).otherwise(1.0))


def registered(registry: DataFrame, name: str, metrics: dict[str, float]) -> DataFrame:
    """A registry (name, version, alias, metric values) with one more version of a model; aliases stay where they are."""
    version = registry.filter(F.col("name") == name).agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version"))
    values = F.create_map(*(F.lit(x) for kv in metrics.items() for x in kv)).cast("map<string,double>")
    return registry.unionByName(version.select(
        F.lit(name).alias("name"),
        "version",
        F.lit(None).cast("string").alias("alias"),
        values.alias("metrics"),
    ))


def aliased(registry: DataFrame, name: str, version: int, alias: str) -> DataFrame:
    """The registry with an alias on one version of a model and on no other of it."""
    mine, own = F.col("name") == name, F.col("version") == version
    moved = F.when(mine & own, F.lit(alias)).when(mine & (F.col("alias") == alias), F.lit(None)).otherwise(F.col("alias"))
    return registry.withColumn("alias", moved.cast("string"))


def fit_logistic(rows: DataFrame, numeric: list[str], categorical: list[str], label: str, iterations: int = 1000) -> PipelineModel:
    """Balanced logistic regression behind the preprocessing; fitted on the given rows only."""
    data = balanced(cleaned(rows, numeric, categorical, label), label)
    return Pipeline(stages=[
        *preprocessing(numeric, categorical),
        LogisticRegression(labelCol=label, weightCol="_weight", maxIter=iterations),
    ]).fit(data)


def fit_boosted(
    rows: DataFrame,
    numeric: list[str],
    categorical: list[str],
    label: str,
    trees: int = 200,
    depth: int = 3,
    rate: float = 0.05,
    subsample: float = 0.85,
) -> PipelineModel:
    """Boosted trees with positives weighted by negatives / positives."""
    data = positive_weighted(cleaned(rows, numeric, categorical, label), label)
    return Pipeline(stages=[
        *preprocessing(numeric, categorical),
        GBTClassifier(labelCol=label, weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, seed=7),
    ]).fit(data)


def scored(model: PipelineModel, rows: DataFrame, numeric: list[str], categorical: list[str], *keep: str) -> DataFrame:
    """keep and the positive class's probability."""
    return model.transform(cleaned(rows, numeric, categorical, *keep)).select(*keep, vector_to_array("probability")[1].alias("score"))


def most_frequent(rows: DataFrame, label: str) -> DataFrame:
    """The constant that the dummy baseline predicts."""
    return rows.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), label).limit(1).select(F.col(label).alias("prediction"))


def coefficients(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """name, coefficient and size of each input of a fitted logistic regression, largest first."""
    last = model.stages[-1]
    attributes = model.transform(rows).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    data = [(names[i], float(v), abs(float(v))) for i, v in enumerate(last.coefficients)]
    return rows.sparkSession.createDataFrame(data, "name string, coefficient double, size double").orderBy(F.col("size").desc(), "name")
