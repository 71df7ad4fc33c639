"""Validation of alleles against the reference sequence: the first failing rule names the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.functions import alleles, sequence
from genoframe.operators.contigs import with_text

CHROMOSOME = r"^chr([1-9]|1[0-9]|2[0-2]|X|Y)$"


def error_code(chrom: Column, pos: Column, ref: Column, alt: Column, seq: Column, width: int) -> Column:
    """Error of a variant at 1-based ``pos`` on ``chrom`` (with its prefix), whose contig is ``seq``, null if unknown.

    A window that would start before the contig is a mismatch. Null alleles and positions cannot be looked up.
    """
    half, p0 = width // 2, pos - 1
    centre = sequence.piece(sequence.piece(seq, p0 - half, p0 + half), F.lit(half), F.lit(half) + F.length(ref))
    window = sequence.alt_window(seq, pos, ref, alt, width)
    return (
        F.when(seq.isNull() | ~F.coalesce(chrom.rlike(CHROMOSOME), F.lit(False)), "INVALID_CHROMOSOME")
        .when(~sequence.only_bases(ref), "INVALID_REFERENCE")
        .when(~sequence.only_bases(alt), "INVALID_ALTERNATE")
        .when(ref.isNull() | alt.isNull() | pos.isNull(), "GENOME_ACCESS_ERROR")
        .when((p0 < half) | (centre != ref), "REF_MISMATCH")
        .when(F.length(window) != width, "ALT_LENGTH_MISMATCH")
        .when(F.substring(window, half + 1, 1 << 20).substr(F.lit(1), F.length(alt)) != alt, "ALT_MISMATCH")
    )


def validate(variants: DataFrame, contigs: DataFrame, width: int = 2114, key: str = "chrom") -> DataFrame:
    """Adds ``error_code, status`` to ``variants(chrom, pos, ref, alt)``; ``contigs``, whole or chunked, are joined by ``key``.

    A variant meets the chunk of its contig that holds its window, not the contig.

    A mismatch of the reference has a status of its own; other errors fail; what is already unsupported stays as it is.
    """
    named = variants.withColumn("chrom", alleles.with_chr(F.col("chrom")))
    place = F.col("pos") - 1
    joined = with_text(named, contigs, key, place - width // 2, place + F.length("ref") + width)
    code = error_code(F.col("chrom"), F.col("pos") - F.col("_offset"), F.col("ref"), F.col("alt"), F.col("_seq"), width)
    if "error_code" in variants.columns:
        code = F.coalesce(F.col("error_code"), code)
        done = F.col("status") == alleles.UNSUPPORTED
    else:
        done = F.lit(False)
    out = joined.withColumn("error_code", code).drop("_seq", "_offset")
    status = F.when(done, alleles.UNSUPPORTED).when(F.col("error_code").isNull(), alleles.PENDING).when(F.col("error_code") == "REF_MISMATCH", alleles.REF_MISMATCH).otherwise(alleles.FAILED)
    return out.withColumn("status", status)


def summary(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status", "error_code").agg(F.count(F.lit(1)).alias("n"))
