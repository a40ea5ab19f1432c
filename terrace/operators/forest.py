"""Isolation-forest outliers as Spark jobs (M4; Liu, Ting and Zhou, 2008).

Each tree is grown in its own task from at most ``psi`` sampled rows; the
forest (at most ``trees * (2 * psi - 1)`` nodes) is then broadcast and every
row is scored where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.ratios import round_to
from terrace.operators.stats import standardize, zscore_outliers
from terrace.sources.sinks import stage

CONTAMINATION = 0.15
MIN_COMPLETE = 5
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n: np.ndarray | int) -> np.ndarray | float:
    """Expected path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big))


def _sample(points: DataFrame, key: str, rows: int, trees: int, psi: int, seed: int) -> DataFrame:
    """``psi`` rows per tree, chosen by hash so that partitioning does not matter.

    Every tree draws from all rows: a row joins the trees for which its hash falls below one share, the same rule at every
    size. The share leaves a margin of eight standard deviations above ``psi`` expected rows, so that no tree falls short.
    """
    share = (psi + 8.0 * math.sqrt(psi) + 16.0) / max(rows, 1)
    hashed = lambda tree: F.xxhash64(F.col(key), tree, F.lit(seed))
    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: _unit(hashed(tree)) < share)
    per_tree = points.withColumn("tree", F.explode(drawn)).withColumn("_hash", hashed(F.col("tree")))
    draw = Window.partitionBy("tree").orderBy("_hash", key)
    return per_tree.withColumn("_draw", F.row_number().over(draw)).filter(F.col("_draw") <= psi)


def _unit(h: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return h / F.lit(2.0**64) + F.lit(0.5)


def _grower(features: Sequence[str], limit: int, seed: int):
    cols = list(features)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        data = rows.sort_values("_draw")[cols].to_numpy(dtype=float)
        nodes: list[list] = []
        pending = [(np.arange(len(data)), 0, None, None)]
        while pending:
            members, depth, parent, side = pending.pop()
            node = len(nodes)
            if parent is not None:
                nodes[parent][side] = node
            part = data[members]
            low, high = part.min(axis=0), part.max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or not len(splittable):
                nodes.append([tree, node, -1, 0.0, -1, -1, depth + float(average_path(len(members)))])
                continue
            f = int(rng.choice(splittable))
            cut = float(rng.uniform(low[f], high[f]))
            goes_left = part[:, f] <= cut
            nodes.append([tree, node, f, cut, -1, -1, 0.0])
            pending.append((members[~goes_left], depth + 1, node, 5))
            pending.append((members[goes_left], depth + 1, node, 4))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    return grow


def isolation_scores(
    df: DataFrame, key: str, features: Sequence[str], trees: int = 100, psi: int = 256, seed: int = 42
) -> DataFrame:
    """M4: every complete row with its anomaly ``score`` (near 1 is anomalous)."""
    complete = df.dropna(subset=list(features))
    marks = [f"_x{i}" for i in range(len(features))]
    points = complete.select("*", *(F.col(f).cast("double").alias(m) for f, m in zip(features, marks)))
    points = stage(standardize(points, marks), "points")
    rows = points.count()
    psi = max(1, min(psi, rows))
    limit = math.ceil(math.log2(psi)) if psi > 1 else 0
    sample = _sample(points.select(key, *marks), key, rows, trees, psi, seed)
    grown = sample.groupBy("tree").applyInPandas(_grower(marks, limit, seed), NODE_SCHEMA)
    # Bounded by trees * (2 * psi - 1) nodes, independent of the data.
    nodes = grown.toPandas().sort_values(["tree", "node"])
    forest = df.sparkSession.sparkContext.broadcast(
        [
            tuple(t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path"))
            for _, t in nodes.groupby("tree")
        ]
    )
    scale = float(average_path(psi)) or 1.0
    depth = limit

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        at = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, threshold, left, right, path in forest.value:
            node = np.zeros(len(x), dtype=int)
            for _ in range(depth):
                f = feature[node]
                inner = f >= 0
                goes_left = x[at, np.where(inner, f, 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            total += path[node]
        return pd.Series(np.power(2.0, -total / (len(forest.value) * scale)))

    return stage(points.withColumn("score", score(*marks)).drop(*marks), "scores")


def isolation_outliers(df: DataFrame, key: str, features: Sequence[str], contamination: float = CONTAMINATION, **forest) -> DataFrame:
    """M4: the rows scoring above the (1 - contamination) quantile, which is exact."""
    scored = isolation_scores(df, key, features, **forest)
    return scored.filter(F.col("score") > _quantile(scored, "score", 1.0 - contamination))


def _quantile(df: DataFrame, col: str, share: float) -> Column:
    """The smallest value with at least ``share`` of the rows at or below it.

    A sketch brackets it; the rank inside the bracket, a few thousandths of the rows, is then counted exactly.
    """
    error = 1e-3
    bounds = [max(share - error, 0.0), min(share + error, 1.0)]
    low, high, rows = df.agg(F.percentile_approx(col, bounds, 10_000).alias("b"), F.count(col).alias("n")).select(F.col("b")[0], F.col("b")[1], "n").first()
    if not rows:
        return F.lit(None).cast("double")
    rank = max(math.ceil(share * rows - 1e-9), 1)
    below = df.filter(F.col(col) < low).count()
    found = df.filter(F.col(col).between(low, high)).orderBy(col).offset(rank - below - 1).limit(1).select(col).first()
    return F.lit(found[0])


def describe_outliers(outliers: DataFrame, name: str = "country_name") -> DataFrame:
    """M4: name, volume, movie ratio, duration and a reason in words."""
    ratio = round_to(F.col("movie_count") / (F.col("titles_count") + F.lit(1e-5)) * 100, 1)
    return outliers.select(
        F.col(name).alias("name"),
        "titles_count",
        ratio.alias("movie_ratio_pct"),
        F.col("avg_movie_duration").alias("avg_duration"),
        F.concat(
            F.lit("Unusual content profile ("), ratio.cast("string"), F.lit("% movies, avg duration "),
            F.col("avg_movie_duration").cast("string"), F.lit(" min)"),
        ).alias("reason"),
    )


def detect_outliers(
    df: DataFrame, name: str, features: Sequence[str], contamination: float = CONTAMINATION, volume: str = "titles_count", **forest
) -> DataFrame:
    """M4 with M3: unusual profiles by isolation forest, or unusual volumes where fewer than five rows have all features.

    ``name``, the volume, ``movie_ratio_pct`` and ``avg_duration`` (NULL for volumes), ``z_score`` (NULL for profiles), ``reason``.
    The z-scores are taken over all rows with a volume, complete or not.
    """
    ratio, length = F.col("movie_ratio_pct"), F.col("avg_duration")
    if df.dropna(subset=list(features)).limit(MIN_COMPLETE).count() < MIN_COMPLETE:
        found = zscore_outliers(df.filter(F.col(volume).isNotNull()), name, volume)
        none = F.lit(None).cast("double")
        return found.select(F.col(name).alias("name"), volume, none.alias("movie_ratio_pct"), none.alias("avg_duration"), "z_score", "reason")
    found = describe_outliers(isolation_outliers(df, name, features, contamination, **forest), name)
    kinds = (ratio.cast("double").alias("movie_ratio_pct"), length.cast("double").alias("avg_duration"))
    return found.select("name", volume, *kinds, F.lit(None).cast("double").alias("z_score"), "reason")
