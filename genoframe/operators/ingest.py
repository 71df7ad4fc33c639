"""Occurrences of variants: one row per record and alternate allele, their statuses and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.functions import alleles


def split_alts(records: DataFrame, alt: str = "alt_raw") -> DataFrame:
    """A row per alternate allele in order: ``alt``, ``alt_index`` from 1; a record with a null list has none."""
    out = records.select("*", F.posexplode(F.split(F.col(alt), ",")).alias("_i", "alt"))
    return out.withColumn("alt_index", F.col("_i") + 1).drop("_i", alt)


def classify(occurrences: DataFrame) -> DataFrame:
    """Adds ``error_code`` and ``status``: unsupported alleles are set aside, the others await validation."""
    out = occurrences.withColumn("error_code", alleles.alt_error_code(F.col("ref"), F.col("alt")))
    return out.withColumn("status", F.when(F.col("error_code").isNull(), alleles.PENDING).otherwise(alleles.UNSUPPORTED))


def mask_target(occurrences: DataFrame, gt: str = "gt") -> DataFrame:
    """Supported alleles that the target sample's genotype lacks become ``NOT_CARRIED_BY_TARGET``; a null genotype carries nothing."""
    carried = F.coalesce(F.array_contains(gt, F.col("alt_index")), F.lit(False))
    lost = F.col("error_code").isNull() & ~carried
    code, status = F.when(lost, "NOT_CARRIED_BY_TARGET").otherwise(F.col("error_code")), F.when(lost, alleles.UNSUPPORTED).otherwise(F.col("status"))
    return occurrences.withColumns({"error_code": code, "status": status})


def with_canonical_id(df: DataFrame, chrom: str = "chrom", name: str = "canonical_id") -> DataFrame:
    return df.withColumn(name, alleles.canonical_id(F.col(chrom), F.col("pos"), F.col("ref"), F.col("alt")))


def canonical(occurrences: DataFrame) -> DataFrame:
    """Distinct supported alleles."""
    return with_canonical_id(occurrences.where("error_code IS NULL")).select("canonical_id", "chrom", "pos", "ref", "alt").distinct()


def counts(records: DataFrame, occurrences: DataFrame) -> DataFrame:
    """One row: records, alternate alleles, valid, unsupported, target-excluded, unique and duplicate ones."""
    n = records.agg(F.count(F.lit(1)).alias("record_count"))
    good = F.col("error_code").isNull()
    out = (F.col("error_code") == "NOT_CARRIED_BY_TARGET")
    o = with_canonical_id(occurrences).agg(
        F.count(F.lit(1)).alias("alt_count"),
        F.count_if(good).alias("valid_count"),
        F.count_if(~good).alias("unsupported_count"),
        F.count_if(F.coalesce(out, F.lit(False))).alias("target_excluded_count"),
        F.count_distinct(F.when(good, F.col("canonical_id"))).alias("unique_count"),
    )
    # two single rows
    return n.crossJoin(o).withColumn("duplicate_count", F.greatest(F.col("valid_count") - F.col("unique_count"), F.lit(0)))


def is_genomic() -> Column:
    """Whether a record is one that only a genomic VCF has: a ``<NON_REF>`` or ``<*>`` allele, or no allele and a reference block."""
    listed = F.concat(F.lit(","), "alt_raw", F.lit(","))
    named = listed.contains(",<NON_REF>,") | listed.contains(",<*>,")
    block = (F.col("alt_raw") == ".") & (F.col("stop") > F.col("pos"))
    return F.coalesce(named, F.lit(False)) | F.coalesce(block, F.lit(False))


def genomic_vcf_records(records: DataFrame) -> DataFrame:
    return records.where(is_genomic())


class DuplicateKeys(ValueError):
    """Keys that must be unique are not."""


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` itself; raises with the first duplicate key."""
    found = df.groupBy(*keys).count().where("count > 1").first()
    if found is not None:
        raise DuplicateKeys(f"duplicate {', '.join(keys)}: {', '.join(str(found[k]) for k in keys)}")
    return df
