"""Clusters of courses by what they teach."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import scrub
from lectern.operators.features import PIPELINE_COLUMNS, text_pipeline

CLUSTERS = 20
FEATURES = 2_000
SEED = 1


def with_cluster_text(courses: DataFrame) -> DataFrame:
    """Add ``clustering_text_cleaned``: skills, else category, else nothing, scrubbed."""
    raw = F.coalesce(F.col("skills"), F.col("category"), F.lit(""))
    return courses.withColumn("clustering_text_cleaned", scrub(raw))


def _fit(
    courses: DataFrame, k: int, seed: int, num_features: int
) -> tuple[PipelineModel, BisectingKMeansModel, DataFrame]:
    """The features' model, the clusters' model, and ``courses`` with ``__features``."""
    texts = with_cluster_text(courses)
    features = text_pipeline(
        "clustering_text_cleaned", "__features", num_features, normalize=False
    ).fit(texts)
    ready = features.transform(texts)
    training = ready.select("__features").persist()
    try:
        model = BisectingKMeans(
            featuresCol="__features", predictionCol="__cluster", k=k, seed=seed
        ).fit(training)
    finally:
        training.unpersist()
    return features, model, ready


def cluster_courses(
    courses: DataFrame,
    k: int = CLUSTERS,
    seed: int = SEED,
    num_features: int = FEATURES,
    keep_text: bool = False,
) -> DataFrame:
    """``courses`` with ``cluster`` set by bisecting k-means over hashed TF-IDF.

    There may be fewer than ``k`` clusters. The iterations read features that are
    computed once; labels depend on the seed and on how rows are partitioned.
    """
    _, model, ready = _fit(courses, k, seed, num_features)
    labelled = model.transform(ready).withColumn("cluster", F.col("__cluster"))
    extra = [*PIPELINE_COLUMNS, "__features", "__cluster"]
    if not keep_text:
        extra.append("clustering_text_cleaned")
    return labelled.drop(*extra)


def store_clusters(
    courses: DataFrame,
    path: str,
    k: int = CLUSTERS,
    seed: int = SEED,
    num_features: int = FEATURES,
) -> None:
    """Fit clusters and write their models and names under ``path``.

    Clusters are numbered by the smallest ``_id`` they hold when they are fitted, so the
    numbers say nothing about the order in which the algorithm split them.
    """
    features, model, ready = _fit(courses, k, seed, num_features)
    features.write().save(f"{path}/features")
    model.write().save(f"{path}/model")
    first = model.transform(ready).groupBy("__cluster").agg(F.min("_id").alias("first_id"))
    # At most k rows: the window has as many.
    by_id = Window.orderBy(F.col("first_id").asc_nulls_last(), "__cluster")
    names = first.withColumn("cluster", F.row_number().over(by_id) - 1)
    names.coalesce(1).write.parquet(f"{path}/names")


def assign_clusters(spark: SparkSession, courses: DataFrame, path: str) -> DataFrame:
    """``courses`` with ``cluster`` by stored models; new rows need no new fit.

    A row's cluster depends on its text alone, not on other rows or on partitions. A
    cluster that held no row when it was fitted has no number: its rows get null.
    """
    features = PipelineModel.load(f"{path}/features")
    model = BisectingKMeansModel.load(f"{path}/model")
    labelled = model.transform(features.transform(with_cluster_text(courses.drop("cluster"))))
    names = spark.read.parquet(f"{path}/names").select("__cluster", "cluster")
    found = labelled.join(F.broadcast(names), "__cluster", "left")
    order = courses.columns if "cluster" in courses.columns else [*courses.columns, "cluster"]
    return found.select(*[F.col(f"`{c}`") for c in order])
