"""Texts of genotypes, annotation fields and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_gt(gt: Column, phased: Column) -> Column:
    """Alleles joined by | or /, a null allele as a dot; a null genotype is ./."""
    joined = lambda sep: F.array_join(F.transform(gt, lambda a: a.cast("string")), sep, ".")
    return F.when(gt.isNull(), "./.").when(phased, joined("|")).otherwise(joined("/"))


def format_values(values: Column) -> Column:
    """Comma list; null items are dots, a null list is empty."""
    return F.coalesce(F.array_join(F.transform(values, lambda v: v.cast("string")), ",", "."), F.lit(""))


def per_alt(values: Column, alt_index: Column) -> Column:
    """Value of the alternate allele (1-based), or the empty text."""
    return F.coalesce(F.try_element_at(values, alt_index.cast("int")).cast("string"), F.lit(""))


def motif_name(name: Column) -> Column:
    """``pos_1_patterns.NAME#1_232`` to ``NAME#1``: after ``patterns.``, without the last ``_`` part."""
    return F.regexp_extract(name, r"patterns\.(.*?)(?:_[^_]*)?$", 1)


def first_gene(listed: Column) -> Column:
    """Name of the first gene of a JSON list: the first of gene_name, symbol, name, gene_id that is not empty, else the
    element itself; text that is no JSON stays as it is."""
    key = lambda k: F.nullif(F.get_json_object(listed, f"$[0].{k}"), F.lit(""))
    whole = F.get_json_object(listed, "$")
    return F.when(whole.isNull(), listed).when(whole == "[]", F.lit(None)).otherwise(F.coalesce(key("gene_name"), key("symbol"), key("name"), key("gene_id"), F.get_json_object(listed, "$[0]"), whole))


def format_score(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("."))


def format_flag(value: Column) -> Column:
    return F.when(value, "1").when(~value, "0").otherwise(".")


def model_score_entry(alt_index: Column, short_id: Column, logfc: Column, jsd: Column, quantile: Column, in_peak: Column, prioritized: Column, number=format_score) -> Column:
    """``alt|model|logfc|jsd|quantile|in_peak|prioritized``; null if all five values are."""
    known = F.greatest(*[v.isNotNull() for v in (logfc, jsd, quantile, in_peak, prioritized)])
    return F.when(known, F.concat_ws("|", alt_index.cast("string"), short_id, number(logfc), number(jsd), number(quantile), format_flag(in_peak), format_flag(prioritized)))
