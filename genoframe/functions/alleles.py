"""Column expressions on alleles and variant identity; all native, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PENDING, UNSUPPORTED, FAILED, REF_MISMATCH = "PENDING", "UNSUPPORTED", "FAILED", "REF_MISMATCH"


def alt_error_code(ref: Column, alt: Column) -> Column:
    """Why an alternate allele is not supported; the first reason that holds, else null."""
    return (
        F.when(alt == "*", "SPANNING_DELETION")
        .when(alt.startswith("<") & alt.endswith(">"), "SYMBOLIC_ALT")
        .when(alt.contains("[") | alt.contains("]"), "BREAKEND")
        .when(alt == ref, "REF_EQUALS_ALT")
        .when(alt.isNull() | alt.isin("", "."), "MISSING_ALT")
    )


def is_sequence_alt(ref: Column, alt: Column) -> Column:
    """Whether the older batch reader keeps the allele; a null is missing."""
    return F.coalesce(~(alt.isin("*", ".", "") | (alt.startswith("<") & alt.endswith(">")) | alt.contains("[") | alt.contains("]") | (alt == ref)), F.lit(False))


def variant_type(ref: Column, alt: Column) -> Column:
    a, r = F.length(alt), F.length(ref)
    return F.when(a > r, "insertion").when(a < r, "deletion").when(a == 1, "SNV").otherwise("substitution")


def variant_length(ref: Column, alt: Column) -> Column:
    return F.greatest(F.length(ref), F.length(alt))


def with_chr(chrom: Column) -> Column:
    return F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def without_chr(chrom: Column) -> Column:
    """Every occurrence of the prefix goes, as the lookup tables' keys want it."""
    return F.replace(chrom, F.lit("chr"), F.lit(""))


def canonical_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", chrom, pos.cast("string"), ref, alt)


def contig_rank(chrom: Column, contigs: list[str]) -> Column:
    """Place of the contig in the header's order; null if it is not listed."""
    return F.nullif(F.array_position(F.lit(contigs), chrom), F.lit(0))


def span_end(pos: Column, ref: Column) -> Column:
    """Last base, inclusive, that a variant touches."""
    return pos + F.length(ref) - 1
