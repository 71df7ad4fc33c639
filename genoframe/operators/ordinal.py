"""Dense ordinals over a total order, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

#: The least and most slices there are; between them, as many as shuffle partitions.
FEWEST, MOST = 16, 4096
#: Bits of a row id that count rows within a partition.
PLACE = (1 << 33) - 1


def _slices(spark: SparkSession) -> int:
    return max(FEWEST, min(MOST, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def with_slice(df: DataFrame, key: str, name: str) -> DataFrame:
    """Adds how many of the column's approximate quantiles lie below a row's value; nulls are before all.

    Slices hold about equal numbers of rows however the values are spread; only rows of one value are never parted. The quantiles are
    bisected: a column and a comparison for each halving.
    """
    slices = _slices(df.sparkSession)
    cuts = df.agg(F.percentile_approx(key, [k / slices for k in range(1, slices)], 10 * slices)).first()[0]
    out = df.withColumn(name, F.lit(0))
    if not cuts:
        return out
    value, table, step = F.col(key), F.lit(cuts), 1 << (len(cuts).bit_length() - 1)
    while step:  # a place beyond the last cut is null and not below
        out = out.withColumn(name, F.col(name) + F.when(value > F.get(table, F.col(name) + (step - 1)), step).otherwise(0))
        step >>= 1
    return out


def with_ordinal(df: DataFrame, order: list[str], name: str = "record_ordinal") -> DataFrame:
    """Adds the 0-based place of each row in ``order``, whose first column is numeric and not null.

    The first column is cut at its quantiles into slices, as many as suit the session's shuffle partitions; rows are counted per slice,
    the few counts are summed up, and each slice is sorted in a partition of its own, where row ids rise without a gap. Rows equal in
    all of ``order`` are numbered arbitrarily.
    """
    sliced = with_slice(df, order[0], "_slice")
    counts = sliced.groupBy("_slice").count()
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    placed = sliced.repartitionById(_slices(df.sparkSession), "_slice").sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(PLACE))
    # MOST rows at most
    return placed.join(F.broadcast(offsets), "_slice").withColumn(name, F.col("_offset") + F.col("_place")).drop("_slice", "_offset", "_place")


#: Neighbouring ordinals that are compared in one task.
RUN = 1 << 16


def descents(df: DataFrame, ordinal: str, *keys: str) -> DataFrame:
    """Rows whose ``keys`` are below those of the row one ordinal earlier; neighbours meet within runs of ordinals, and the last row of
    a run is sent to the next one too."""
    at, run = F.col(ordinal), F.expr(f"`{ordinal}` div {RUN}")
    sent = df.withColumn("_run", F.explode(F.when(at % RUN == RUN - 1, F.array(run, run + 1)).otherwise(F.array(run))))
    near = Window.partitionBy("_run").orderBy(ordinal)
    met = sent.withColumns({"_at": F.lag(ordinal).over(near), "_before": F.lag(F.struct(*keys)).over(near)})
    return met.where((run == F.col("_run")) & (F.col("_at") == at - 1) & (F.struct(*keys) < F.col("_before"))).drop("_run", "_at", "_before")


def first_wrong_by(df: DataFrame, by: list[str], ordinal: str, keys: list[str], mark: str) -> DataFrame:
    """For each ``by``: ``descent``, the first ordinal whose ``keys`` are below those of the row before, and ``marked``, the first one that
    has ``mark``, each null if there is none; one pass over ``df``: neighbours meet within runs of ordinals, and the ends of the runs
    after that."""
    named = [f"_key{k}" for k in range(len(keys))]
    own = df.select(*by, F.col(ordinal).alias("_at"), *[F.col(c).alias(k) for c, k in zip(keys, named, strict=True)], F.col(mark).alias("_mark")).withColumn("_run", F.expr(f"_at div {RUN}"))
    near = Window.partitionBy(*by, "_run").orderBy("_at")
    within = own.withColumns({"_down": F.struct(*named) < F.lag(F.struct(*named)).over(near), "_begins": F.lag("_at").over(near).isNull(), "_ends": F.lead("_at").over(near).isNull()})
    # one row begins a run and one ends it; plain numbers are summed up by hashing, structs would be sorted
    of = lambda flag: [F.max(F.when(F.col(flag), F.col(k))).alias(flag + k) for k in named]
    runs = within.groupBy(*by, "_run").agg(F.min(F.when(F.col("_down"), F.col("_at"))).alias("d"), F.min(F.when(F.col("_mark"), F.col("_at"))).alias("m"), F.min("_at").alias("_from"), *of("_begins"), *of("_ends"))
    # a row a run
    before = F.lag(F.struct(*["_ends" + k for k in named])).over(Window.partitionBy(*by).orderBy("_run"))
    ends = runs.withColumn("e", F.when(F.struct(*["_begins" + k for k in named]) < before, F.col("_from")))
    return ends.groupBy(*by).agg(F.min(F.least("d", "e")).alias("descent"), F.min("m").alias("marked"))


def first_wrong(df: DataFrame, ordinal: str, keys: list[str], mark: str) -> Row:
    """``descent, marked`` of all rows, see ``first_wrong_by``."""
    return first_wrong_by(df, [], ordinal, keys, mark).first()
