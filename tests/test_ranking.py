"""Running totals and growth over any order, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import ranking


def plain_totals(rows):
    """NULL order values come first; a NULL measure adds nothing, and no measure at all is NULL."""
    place = lambda k: -1 if k is None else k
    out = []
    for k, m in rows:
        seen = [x for y, x in rows if x is not None and place(y) <= place(k)]
        out.append((k, m, sum(seen) if seen else None))
    return out


def show(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("values", [range(50), range(3), [None, 1, 2, 3]])
def test_slices_equal_one_window(spark, values):
    rng = random.Random(len(list(values)))
    rows = [(rng.choice(list(values)), rng.choice([None, 1, 2, 5, 9])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k long, m long")
    sliced, whole = (ranking.running_total(df, "k", "m", "total", bounded=b) for b in (False, True))
    assert show(sliced) == show(whole) == sorted(map(str, plain_totals(rows)))
    sliced, whole = (ranking.growth(df, "k", "m", "pct", bounded=b) for b in (False, True))
    assert show(sliced) == show(whole)


def test_no_task_sees_all_rows(spark):
    df = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("m"))
    for result in (ranking.running_total(df, "k", "m", "out"), ranking.growth(df, "k", "m", "out")):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and plan.count("Window") >= 1


def test_nothing_to_sum(spark):
    none = spark.createDataFrame([], "k long, m double")
    assert ranking.running_total(none, "k", "m", "t").count() == ranking.growth(none, "k", "m", "g").count() == 0
