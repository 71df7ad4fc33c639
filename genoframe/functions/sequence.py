"""Sequence windows around variants; ``seq`` is the contig's text, positions are 1-based unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "ACGT"


def piece(seq: Column, start0: Column, end0: Column) -> Column:
    """Half-open 0-based slice, cut at the contig's ends; empty when nothing is left."""
    begin = F.greatest(start0, F.lit(0))
    return F.substring(seq, (begin + 1).cast("int"), F.greatest(end0 - begin, F.lit(0)).cast("int"))


def only_bases(x: Column) -> Column:
    """Whether all letters are A, C, G or T in upper case; the empty text passes."""
    return F.translate(x, BASES, "") == ""


def alt_window(seq: Column, pos: Column, ref: Column, alt: Column, width: int) -> Column:
    """Left half, alternate allele, and as much sequence after the reference allele as fills the width."""
    half, p0 = width // 2, pos - 1
    after = p0 + F.length(ref)
    return F.concat(piece(seq, p0 - half, p0), alt, piece(seq, after, after + half - F.length(alt)))


def allele_windows(seq: Column, pos: Column, ref: Column, alt: Column, width: int) -> tuple[Column, Column]:
    """(reference, alternate) windows of exactly ``width``, upper case, padded with N beyond the contig."""
    start = pos - 1 - F.lit(width // 2)
    pad = lambda n: F.repeat(F.lit("N"), F.greatest(n, F.lit(0)).cast("int"))
    left = pad(F.least(-start, F.lit(width // 2)))
    fill = lambda x: F.rpad(F.substring(x, 1, width), width, "N")
    up = F.upper(seq)
    after = pos - 1 + F.length(ref)
    reference = F.concat(pad(-start), piece(up, start, start + width))
    alternate = F.concat(left, piece(up, start, pos - 1), F.upper(alt), piece(up, after, after + width))
    return fill(reference), fill(alternate)


def allele_window_error(seq: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """Why no windows can be built, else null."""
    wrong = lambda x: F.translate(F.upper(x), "ACGTN", "") != ""
    return (
        F.when(pos < 1, "INVALID_POSITION")
        .when((F.coalesce(ref, F.lit("")) == "") | (F.coalesce(alt, F.lit("")) == ""), "EMPTY_ALLELE")
        .when(wrong(ref) | wrong(alt), "INVALID_ALLELE")
        .when(F.upper(piece(seq, pos - 1, pos - 1 + F.length(ref))) != F.upper(ref), "REF_MISMATCH")
    )


def center_slice(seq: Column, width: int = 2114, inner: int = 1000) -> Column:
    return F.substring(seq, width // 2 - inner // 2 + 1, inner)


def center_slice_array(values: Column, width: int = 2114, inner: int = 1000) -> Column:
    return F.slice(values, width // 2 - inner // 2 + 1, inner)


def one_hot(seq: Column) -> Column:
    """Four 0/1 values a base in the order ACGT; other letters are all zero."""
    row = lambda x: F.array(*[(x == b).cast("byte") for b in BASES])
    return F.transform(F.split(F.upper(seq), ""), row)


def base_count(seq: Column, base: str) -> Column:
    return (F.length(seq) - F.length(F.replace(seq, F.lit(base), F.lit("")))).cast("int")


def attribution_sequence(rows: Column) -> Column:
    """Letters of positions x 4 attributions: the first base with a non-zero value, A if all are zero."""
    letter = lambda r: F.when(F.coalesce(r[0], F.lit(0)) != 0, "A").when(r[1] != 0, "C").when(r[2] != 0, "G").when(r[3] != 0, "T").otherwise("A")
    return F.array_join(F.transform(rows, letter), "")


def attribution_sums(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.aggregate(r, F.lit(0.0), lambda a, x: a + x.cast("double")))
