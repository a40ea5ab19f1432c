"""K-means over profile rows (M5)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.stats import standardize
from terrace.sources.sinks import run_together, stage

MIN_ROWS = 4


def kmeans_members(
    df: DataFrame, name: str, features: Sequence[str], k: int = 3, seed: int = 42, starts: int = 3
) -> DataFrame:
    """M5: (cluster, member) rows from the best of ``starts`` k-means fits on standardised features.

    Rows without all features are left out. Three starts do, as each begins from parallel k-means++ centres rather than from
    random rows; two fits run at a time, so that they do not share the cluster between too many passes. Clusters are numbered by their
    centre on the first feature, so labels do not depend on the start.
    """
    full = df.select(name, *(F.col(c).cast("double").alias(c) for c in features)).dropna(subset=list(features))
    points = VectorAssembler(inputCols=list(features), outputCol="_v").transform(standardize(full, features)).select(name, "_v")
    points = points.persist()
    try:
        n = points.count()
        if n < MIN_ROWS:
            raise ValueError(f"k-means needs at least {MIN_ROWS} complete rows, got {n}")
        fits = [KMeans(k=min(k, n), seed=seed + i, featuresCol="_v", predictionCol="_label") for i in range(starts)]
        models = run_together([partial(fit.fit, points) for fit in fits], width=2)
        best = min(models, key=lambda m: m.summary.trainingCost)
        numbered = sorted(range(len(best.clusterCenters())), key=lambda i: tuple(best.clusterCenters()[i]))
        order = F.array(*(F.lit(numbered.index(i) + 1) for i in range(len(numbered))))
        labelled = best.transform(points).select(F.get(order, F.col("_label")).alias("cluster"), F.col(name).alias("member"))
        return stage(labelled, "clusters")
    finally:
        points.unpersist()


def cluster_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cluster").agg(F.count("*").alias("members"))
