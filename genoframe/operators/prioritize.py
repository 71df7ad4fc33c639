"""Pivot of scores by model, prioritisation, and the headline model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.operators.ingest import require_unique

MIN_LOGFC, MIN_QUANTILE = 0.25, 0.05
VALUES = ("logfc", "active_allele_quantile", "in_peak")


def pivot(scores: DataFrame, index: list[str], models: list[str], values=VALUES, model: str = "model_id", unique: bool = True) -> DataFrame:
    """One row per index with ``<value>_<model>`` columns; a repeated (index, model) is an error; null index values group."""
    if unique:
        require_unique(scores, *index, model)
    wide = scores.groupBy(*index).pivot(model, models).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])
    return wide.select(*index, *[F.col(f"`{m}_{v}`").alias(f"{v}_{m}") for v in values for m in models])


def is_prioritized(logfc: Column, quantile: Column, in_peak: Column, in_promoter: Column) -> Column:
    """Strong and well expressed, and in a promoter, in a peak, or gaining activity outside peaks. Nulls and NaN do not count."""
    number = lambda x: F.when(~F.isnan(x), x)
    lfc, q = number(logfc), number(quantile)
    peak, promoter = F.coalesce(in_peak, F.lit(False)), F.coalesce(in_promoter, F.lit(False))
    return F.coalesce((F.abs(lfc) >= MIN_LOGFC) & (q >= MIN_QUANTILE) & (promoter | peak | (~peak & (lfc > 0))), F.lit(False))


def prioritize(wide: DataFrame, models: list[str], in_promoter: Column | None = None) -> DataFrame:
    """Adds ``prioritized_<model>`` and ``prioritized``, whether any is."""
    promoter = F.lit(False) if in_promoter is None else in_promoter
    flags = {m: is_prioritized(F.col(f"logfc_{m}"), F.col(f"active_allele_quantile_{m}"), F.col(f"in_peak_{m}"), promoter) for m in models}
    out = wide.select("*", *[f.alias(f"prioritized_{m}") for m, f in flags.items()])
    any_ = F.lit(False)
    for m in models:
        any_ = any_ | F.col(f"prioritized_{m}")
    return out.withColumn("prioritized", any_)


def top_model(prioritized: DataFrame, models: list[str]) -> DataFrame:
    """Adds ``top_model, top_logfc``: the greatest absolute fold change, among the prioritised models if there is any;
    ties go to the first name, the value keeps its sign."""
    def size(m: str) -> Column:
        own = F.coalesce(F.abs(F.col(f"logfc_{m}")), F.lit(0.0))
        return F.when(F.col("prioritized") & ~F.col(f"prioritized_{m}"), 0.0).otherwise(own)

    ranked = sorted(models)
    rows = F.array(*[F.struct(size(m).alias("size"), F.lit(-k).alias("turn"), F.lit(m).alias("model"), F.col(f"logfc_{m}").alias("logfc")) for k, m in enumerate(ranked)])
    best = F.array_max(rows)
    return prioritized.withColumn("_best", best).withColumn("top_model", F.col("_best.model")).withColumn("top_logfc", F.col("_best.logfc")).drop("_best")
