"""Motif hits that overlap a variant in the middle of its window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The window's width, whose middle is the variant's place, and the least coefficient of a hit.
WIDTH, LEAST = 2114, 10.0


def motif_name(name: Column) -> Column:
    """The part of ``pos_1_patterns.ATF3#1_232`` that names the motif: ``ATF3#1``."""
    return F.regexp_replace(F.regexp_replace(name, r"^.*?patterns\.", ""), r"_[^_]*$", "")


def overlapping(variants: DataFrame, hits: DataFrame, key: list[str], on: list[str], length: Column, width: int = WIDTH) -> DataFrame:
    """``key, motifs``: for each of ``variants`` the sorted names of the hits of its window that its span overlaps, empty without any.

    ``hits(start, end, motif)`` and the columns ``on`` that name the window; the span has ``length`` letters from the window's middle.
    """
    middle = width // 2
    names = [f"_{c}" for c in on]
    rows = variants.select(*key, *[F.col(c).alias(n) for c, n in zip(on, names, strict=True)], (F.lit(middle) + length - 1).alias("_last"))
    held = hits.select(*[F.col(c).alias(f"{n}_hit") for c, n in zip(on, names, strict=True)], "start", "end", "motif").where(F.col("end") >= middle)
    same = [F.col(n) == F.col(f"{n}_hit") for n in names]
    # each window and length meets the hits once; variants that share them share the list
    asked = rows.select(*names, "_last").distinct()
    lists = asked.join(held, [*same, F.col("start") <= F.col("_last")]).groupBy(*names, "_last").agg(F.array_sort(F.collect_list("motif")).alias("motifs"))
    lists = lists.toDF(*[f"{n}_of" for n in names], "_last_of", "motifs")
    met = [F.col(n) == F.col(f"{n}_of") for n in (*names, "_last")]
    none = F.array().cast("array<string>")
    # rows of one key are counted before they have lists: the lists of those that are alone are not shuffled again
    counted = rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    alone = counted.where("_n = 1").join(lists, met, "left").select(*key, F.coalesce("motifs", none).alias("motifs"))
    repeated = counted.where("_n > 1").join(lists, met, "left").groupBy(*key).agg(F.array_sort(F.flatten(F.collect_list(F.coalesce("motifs", none)))).alias("motifs"))
    return alone.unionByName(repeated)


def strong(hits: DataFrame, least: float = LEAST) -> DataFrame:
    """``peak_id, start, end, motif`` of ``hits(peak_id, start, end, motif_name, hit_coefficient)`` with a coefficient of ``least`` or more."""
    return hits.where(F.col("hit_coefficient") >= least).select("peak_id", "start", "end", motif_name(F.col("motif_name")).alias("motif"))
