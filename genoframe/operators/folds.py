"""Averages over model folds; folds meet by key, never by row position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.operators.ordinal import with_slice


def mean_of_all(value: Column, n: int) -> Column:
    """Mean, null unless all ``n`` folds have a value that is a number."""
    good = F.when(~F.isnan(value), value)
    return F.when(F.count(good) == n, F.avg(good))


def geometric_mean_of_all(value: Column, n: int) -> Column:
    good = F.when(~F.isnan(value), value)
    return F.when(F.count(good) == n, F.pow(F.product(good), F.lit(1.0 / n)))


def mean_of_present(value: Column) -> Column:
    """Mean of the values there are; none gives null."""
    return F.avg(F.when(~F.isnan(value), value))


def average(folds: DataFrame, keys: list[str], columns: list[str], n: int) -> DataFrame:
    """``n_folds`` and each column's mean by key; columns with ``pval`` in their name have the geometric mean."""
    aggs = [(geometric_mean_of_all if "pval" in c else mean_of_all)(F.col(c), n).alias(c) for c in columns]
    return folds.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n_folds"))


class FoldMismatch(ValueError):
    """Folds do not hold the same variants."""


def membership(folds: DataFrame, fold: str, key: str, first) -> DataFrame:
    """``fold, side, key`` of every variant that a fold lacks (``missing``) or has beyond the first fold (``extra``)."""
    ids = folds.select(fold, key).distinct()
    base = ids.where(F.col(fold) == first).select(key)
    # folds are few: their names come to the driver, ids do not
    others = sorted(r[0] for r in ids.select(fold).distinct().collect() if r[0] != first)
    expected = base.withColumn(fold, F.explode(F.lit(others) if others else F.array().cast(f"array<{ids.schema[fold].dataType.simpleString()}>")))
    missing = expected.join(ids, [fold, key], "left_anti").select(fold, F.lit("missing").alias("side"), key)
    extra = ids.where(F.col(fold) != first).join(base, key, "left_anti").select(fold, F.lit("extra").alias("side"), key)
    return missing.unionByName(extra)


def require_same_members(folds: DataFrame, fold: str, key: str, first) -> DataFrame:
    row = membership(folds, fold, key, first).first()
    if row is not None:
        raise FoldMismatch(f"fold {row[fold]} {row['side']} {row[key]}")
    return folds


def array_mean(df: DataFrame, keys: list[str], values: str) -> DataFrame:
    """``keys, bin, mean``: means by position of arrays; positions count from 0."""
    return df.select(*keys, F.posexplode(values).alias("bin", "_v")).groupBy(*keys, "bin").agg(F.avg(F.col("_v").cast("double")).alias("mean"))


def distribution(df: DataFrame, value: str, points: int = 1000) -> DataFrame:
    """``i, value``: the values at ``i * n div points`` of the sorted column; needs ``points`` rows at least.

    Values are numbered within slices between their quantiles, so they are not sorted in one task.
    """
    clean = df.select(F.col(value).cast("double").alias("value")).where("value IS NOT NULL AND NOT isnan(value)")
    n = clean.count()
    if n < points:
        raise ValueError(f"a distribution of {points} points needs as many values; there are {n}")
    sliced = with_slice(clean, "value", "slice")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("slice").count().select("slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    placed = sliced.withColumn("k", F.row_number().over(Window.partitionBy("slice").orderBy("value"))).join(F.broadcast(offsets), "slice").withColumn("at", F.col("offset") + F.col("k") - 1)
    wanted = df.sparkSession.range(points).select(F.col("id").alias("i"), F.expr(f"id * {n} div {points}").alias("at"))
    return placed.join(F.broadcast(wanted), "at").select("i", "value")
