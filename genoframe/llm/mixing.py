"""Mixing sources to target weights: a time-varying curriculum, in DataFrame functions only.

Every source has a weight schedule, piecewise constant over training time [0, 1). Its integral is the source's
cumulative token demand; inverting it at a document's cumulative size gives the document's training position.
Passes over a source follow each other, so a document may be placed more than once, up to ``max_passes`` times; a copy
beyond the whole demand has no position and is not taken.
Running sums are two-level (hash bucket, then within a bucket): a source with a third of all rows is
spread over 4096 groups, and no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word: a run of anything but space and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"
#: Buckets in a source's order: the first three hexadecimal digits of a hash.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of maximal runs of bytes other than space and 09-0D; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, owner, bucket, tie`` and the columns to carry: tie is the document's place in its source's
    pseudo-random order, owner a key that is never null.

    Unless more is carried only these narrow columns are shuffled; texts stay where they are scanned. Rows that repeat an id
    in a source have one tie and are interchangeable.
    """
    tie = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    owner = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    kept = [F.col(c).alias(f"_{c}") for c in carry]
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), owner.alias("owner"), tie.alias("tie"), *kept).withColumn("bucket", F.substring("tie", 1, BUCKET_DIGITS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, max_passes: int) -> DataFrame:
    """Targets of ``source, source_size``: ``share`` of all words by cyclic weights over sources in code-point order
    (null last), stopped at ``max_passes`` times the source, the excess shared anew by weight until none is above.

    That fixed point is a water level: with sources ordered by cap / weight, those whose ratio is below the level are
    full. One row per source is ordered globally; the table has a row per source, not per document.
    """
    named = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.array(*[F.lit(x) for x in weights])
    ranked = sizes.withColumn("place", F.row_number().over(named) - 1).withColumn("weight", F.element_at(w, F.col("place") % len(weights) + 1)).withColumn("cap", max_passes * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    filled = (
        ranked.withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.col("full_before")) / F.col("weight_left"))
    )
    # the level to use is that of the first source, in this order, which its own level does not fill
    open_ = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    level = F.first(open_, ignorenulls=True).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return filled.withColumn("level_", level).select(
        "owner", "source", "source_size", "place", "weight", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level_") * F.col("weight"), F.col("cap").cast("double"))).alias("target")
    )


def inverse_demand(share_of_demand: Column, schedule: list[tuple[float, float]]) -> Column:
    """Training time at which a source has used ``share_of_demand`` of its demand; null from 1 on, when all is used.

    ``schedule``: (length of a time step, weight in it); the integral of the weights is inverted piecewise.
    """
    total = sum(dt * w for dt, w in schedule)
    out, time, used = F.lit(1.0), sum(dt for dt, _ in schedule), total
    for dt, w in reversed(schedule):
        time, used = time - dt, used - dt * w
        if w > 0:
            out = F.when(share_of_demand * total < used + dt * w, F.lit(time) + (share_of_demand * total - F.lit(used)) / F.lit(w)).otherwise(out)
    return F.when(share_of_demand < 1, out)


#: Sources at even places fade out over training, those at odd places fade in: weights in quarters of the time.
FADES = ([(0.25, 4.0), (0.25, 3.0), (0.25, 2.0), (0.25, 1.0)], [(0.25, 1.0), (0.25, 2.0), (0.25, 3.0), (0.25, 4.0)])


def position(copy: int, schedules=FADES) -> Column:
    """Training time in [0, 1) of a document's copy number ``copy`` (from 0), null if the demand does not reach it.

    The words of the source before the copy's middle, divided by the source's target, are the share of demand used before it; the
    inverse of the schedule's integral at that share is its time. ``schedules`` go to sources cyclically by place.
    """
    used = F.when(F.col("target") > 0, (F.lit(copy) * F.col("source_size") + F.col("start") + F.col("size") / 2.0) / F.col("target"))
    out = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        out = F.when(F.col("place") % len(schedules) == k, inverse_demand(used, schedule)).otherwise(out)
    return out


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_passes: int = 2, carry: tuple[str, ...] = (), schedules=FADES) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, place, start, positions, passes, taken``.

    ``start`` is the document's offset in its source's order, ``positions`` are the training times of its copies in passes that the
    source's demand reaches: those whose middle word, ``pass * source_size + start + size / 2``, lies below the target. So a
    source's sum differs from its target by half a document at most, and no document is taken more than ``max_passes`` times.
    Null and empty texts have size 0 and take 0; null sources form one source; an empty table gives no rows; other
    columns, whatever their names, are not read unless named in ``carry``.
    """
    sized = sized_documents(docs, carry)
    sums = sized.groupBy("owner", "source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = source_targets(sums.groupBy("owner", "source").agg(F.sum("bucket_size").alias("source_size")), weights, share, max_passes)
    ahead = Window.partitionBy("owner").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("owner", "bucket", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)).alias("bucket_start"))
    plan = starts.join(sources.drop("source"), "owner")
    within = Window.partitionBy("owner", "bucket").orderBy("tie", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = placed.join(plan, ["owner", "bucket"]).withColumn("start", F.col("bucket_start") + F.col("ahead"))
    out = rows.withColumn("positions", F.array_compact(F.array(*[position(p, schedules) for p in range(max_passes)])))
    out = out.withColumn("passes", F.size("positions")).withColumn("taken", F.col("size") * F.col("passes"))
    return out.select("doc_id", "source", "size", "source_size", "target", "place", "start", "positions", "passes", "taken", *[F.col(f"_{c}").alias(c) for c in carry])


def curriculum(mixed: DataFrame) -> DataFrame:
    """A row per taken copy of a document (``pass`` from 0), range-sorted by ``position``; ties go to ``doc_id``, ``pass``."""
    placed = mixed.select("*", F.posexplode("positions").alias("pass", "position"))
    return placed.repartitionByRange("position", "doc_id", "pass").sortWithinPartitions("position", "doc_id", "pass")


def by_first_position(mixed: DataFrame) -> DataFrame:
    """A row per document with the ``position`` of its first copy, range-sorted by it; what the mix leaves out comes first, by ``doc_id``."""
    placed = mixed.withColumn("position", F.get("positions", F.lit(0)))
    return placed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
