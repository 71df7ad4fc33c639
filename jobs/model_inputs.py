"""Model inputs of a set of variants: every allele is validated against its reference text, and those that pass get the reference
and alternate windows that a model reads.

Reads two sources of the settings, ``contigs(contig, seq)`` and ``variants(id, contig, chrom, pos, ref, alt)``. Writes
``OUT/variants``, Parquet partitioned by ``status`` and ``chrom``, and ``OUT/summary``, JSON lines of rows by status and error. A run
replaces both, so it may be repeated or follow one that was stopped.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions import alleles, sequence
from genoframe.operators import contigs, validate
from jobs import common

log = logging.getLogger("jobs.model_inputs")
SCHEMA = "id bigint, contig string, pos bigint, ref string, alt string, error_code string, ref_seq string, alt_seq string, status string, chrom string"


def windows(variants: DataFrame, reference: DataFrame, width: int) -> DataFrame:
    """Variants with ``status, error_code`` and, if they are valid, ``ref_seq, alt_seq``; texts are met once for both.

    Alleles that are valid but empty have no windows and fail with the windows' code. Repeated rows each give a row.
    """
    named = variants.withColumn("chrom", alleles.with_chr(F.col("chrom")))
    at = F.col("pos") - 1
    met = contigs.with_text(named, reference, "contig", at - width // 2, at + F.length("ref") + width)
    local, ref, alt, seq = F.col("pos") - F.col("_offset"), F.col("ref"), F.col("alt"), F.col("_seq")
    code = F.coalesce(validate.error_code(F.col("chrom"), local, ref, alt, seq, width), sequence.allele_window_error(seq, local, ref, alt))
    both = sequence.allele_windows(seq, local, ref, alt, width)
    coded = met.withColumn("error_code", code)
    status = F.when(F.col("error_code").isNull(), alleles.PENDING).when(F.col("error_code") == "REF_MISMATCH", alleles.REF_MISMATCH).otherwise(alleles.FAILED)
    made = [F.when(F.col("error_code").isNull(), x).alias(name) for x, name in zip(both, ("ref_seq", "alt_seq"), strict=True)]
    return coded.select("id", F.col("contig").cast("string").alias("contig"), "pos", "ref", "alt", "error_code", *made, status.alias("status"), "chrom")


def run(spark: SparkSession, tables: str, out: str, config: dict) -> dict:
    """Does the job; returns what it read and wrote."""
    reference, variants = common.table(spark, tables, config["contigs"]), common.table(spark, tables, config["variants"])
    told = {"contigs": reference.select("contig").count(), "variants": variants.select("id").count()}
    for name, n in told.items():
        log.info("read %s: %d rows of %s", common.place(tables, config[name]), n, name)
    rows = windows(variants, reference, config["width"])
    # files of even size: large partitions are split over tasks, small ones put together
    rows.hint("rebalance", "status", "chrom").write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("status", "chrom").parquet(f"{out}/variants")
    summary = read(spark, out).groupBy("status", "error_code").agg(F.count(F.lit(1)).alias("rows"))
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{out}/summary")
    for r in spark.read.schema("status string, error_code string, rows bigint").json(f"{out}/summary").orderBy("status", "error_code").collect():
        told[r.error_code or r.status] = r.rows
        log.info("wrote %s/variants: %d rows with %s, %s", out, r.rows, r.status, r.error_code)
    return told


def read(spark: SparkSession, out: str) -> DataFrame:
    """The variants that a run has written."""
    return spark.read.schema(SCHEMA).parquet(f"{out}/variants")


if __name__ == "__main__":
    common.main("model_inputs", "validate variants against reference texts and write model inputs", run, "out")
