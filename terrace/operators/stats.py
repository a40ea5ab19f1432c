"""Regression, forecast, z-score outliers and standardisation (M1-M3, M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.ratios import round_to

MIN_POINTS = 5
Z_LIMIT = 1.8
STD_FLOOR = 1e-6


def ols_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = (), min_points: int = MIN_POINTS) -> DataFrame:
    """M1: least-squares line of y on x (per group), dropped below ``min_points`` points."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return (
        df.filter(xs.isNotNull() & ys.isNotNull())
        .groupBy(*by)
        .agg(
            F.regr_slope(ys, xs).alias("slope"),
            F.regr_intercept(ys, xs).alias("intercept"),
            F.regr_r2(ys, xs).alias("r2"),
            F.min(x).alias("train_from"),
            F.max(x).alias("train_to"),
            F.count("*").alias("points"),
        )
        .filter(F.col("points") >= min_points)
    )


def rounded_trend(trend: DataFrame) -> DataFrame:
    """M1 as reported: R2 to four digits, slope and intercept to two."""
    return trend.withColumns(
        {"r2": round_to(F.col("r2"), 4), "slope": round_to(F.col("slope"), 2), "intercept": round_to(F.col("intercept"), 2)}
    )


def forecast(trend: DataFrame, periods: int = 5, by: Sequence[str] = (), first: Column | None = None) -> DataFrame:
    """M2: the next periods on the line, rounded half-to-even and never negative.

    The value is taken to six decimals first: the last bits of the fit depend on
    the order of summation and must not decide a tie.
    """
    start = first if first is not None else F.col("train_to") + 1
    steps = trend.withColumn("period", F.explode(F.sequence(start, start + F.lit(periods - 1))))
    on_line = F.col("intercept") + F.col("slope") * F.col("period")
    value = F.greatest(F.lit(0), F.bround(on_line.cast("decimal(38,6)"), 0).cast("long"))
    return steps.select(*by, "period", value.alias("predicted"))


def _population(df: DataFrame, cols: Sequence[str]) -> Column:
    """Means and population deviations of the columns as one scalar struct (one aggregate, used as a subquery)."""
    fields = []
    for c in cols:
        fields += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.agg(F.struct(*fields)).scalar()


def zscore_outliers(df: DataFrame, name: str, measure: str, limit: float = Z_LIMIT) -> DataFrame:
    """M3: rows further than ``limit`` population deviations from the mean."""
    stats = _population(df, [measure])
    mean, std = stats.getField(f"{measure}_mean"), stats.getField(f"{measure}_std") + F.lit(STD_FLOOR)
    z = F.abs((F.col(measure) - mean) / std)
    scored = df.select(F.col(name), F.col(measure), z.alias("_z"), F.bround(mean, 0).cast("long").alias("_mean"))
    return scored.filter(F.col("_z") > limit).select(
        name,
        measure,
        round_to(F.col("_z"), 2).alias("z_score"),
        F.format_string(
            "Significantly higher title volume (%s vs avg %s)", F.col(measure).cast("string"), F.col("_mean").cast("string")
        ).alias("reason"),
    )


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M6: zero mean and unit population deviation; a constant column becomes 0."""
    stats = _population(df, cols)
    out = {}
    for c in cols:
        std = stats.getField(f"{c}_std")
        out[c] = (F.col(c) - stats.getField(f"{c}_mean")) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumns(out)
