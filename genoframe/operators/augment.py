"""Merging results back onto the records of the input file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["record_ordinal", "alt_index"]
#: The fields per alternate allele, their number, type and meaning, in order; names get a prefix.
INFO_FIELDS = (
    ("STATUS", "A", "String", "Result status"),
    ("ERROR", "A", "String", "Error code, or missing"),
    ("PRIORITIZED", "A", "Integer", "Whether the allele is prioritised (1 or 0)"),
    ("MAX_ABS_LOGFC", "A", "Float", "Largest absolute log fold change"),
    ("TOP_MODEL", "A", "String", "Short name of the headline model"),
    ("REGION", "A", "String", "Most severe region label"),
    ("NEAREST_GENE", "A", "String", "Nearest gene"),
    ("CCRE", "A", "String", "Regulatory element"),
    ("GNOMAD_AF", "A", "Float", "Global allele frequency"),
    ("CADD_PHRED", "A", "Float", "Deleteriousness score"),
    ("AM_SCORE", "A", "Float", "Missense pathogenicity"),
    ("AM_CLASS", "A", "String", "Missense class"),
    ("REVEL", "A", "Float", "Ensemble missense score"),
    ("MODEL_SCORE", ".", "String", "allele|model|logfc|jsd|quantile|in peak|prioritised"),
)


class Misaligned(ValueError):
    """Results and records do not match one to one."""


def status(current: Column, result_id: Column) -> Column:
    """PENDING becomes SCORED with a result and NO_RESULT without; a missing status is FAILED; others stay."""
    now = F.coalesce(F.nullif(current, F.lit("")), F.lit("FAILED"))
    return F.when(now == "PENDING", F.when(result_id.isNotNull(), "SCORED").otherwise("NO_RESULT")).otherwise(now)


def misalignment(occurrences: DataFrame, results: DataFrame) -> DataFrame:
    """``side, record_ordinal, alt_index`` of occurrences without a result and results without an occurrence; each side is read once."""
    a, b = occurrences.select(*KEY, F.lit(1).alias("_a")), results.select(*KEY, F.lit(1).alias("_b"))
    side = F.when(F.col("_b").isNull(), "missing_result").otherwise("extra_result").alias("side")
    return a.join(b, KEY, "full").where("_a IS NULL OR _b IS NULL").select(side, *KEY)


def merge(occurrences: DataFrame, results: DataFrame, check: bool = True, by_record: bool = False) -> DataFrame:
    """Occurrences with their results' columns; unless ``check`` is off any misaligned row raises.

    ``by_record`` brings together whole records, whose few alleles are compared there, so that grouping by record moves no row again.
    """
    if check:
        row = misalignment(occurrences, results).first()
        if row is not None:
            raise Misaligned(f"{row.side} at record {row.record_ordinal}, allele {row.alt_index}")
    if not by_record:
        return occurrences.join(results, KEY, "left")
    record, allele = KEY
    other = results.withColumnsRenamed({record: "_record", allele: "_allele"})
    # a difference, as an equality would be taken for a second key of the shuffle
    same = (F.col(record) == F.col("_record")) & (F.col(allele) - F.col("_allele") == 0)
    return occurrences.join(other, same, "left").drop("_record", "_allele")


def short_ids(models: list[dict]) -> list[dict]:
    """Models with ``short_id``: their own, or M and their four-digit place from 1."""
    return [dict(m, short_id=m.get("short_id") or f"M{i:04d}") for i, m in enumerate(models, 1)]


def top_short_id(top: Column, models: list[dict]) -> Column:
    """Short id of the model whose name or column prefix is ``top``; a later model wins a shared name."""
    known = {name: m["short_id"] for m in short_ids(models) for name in (m["name"], m["column_prefix"])}
    out = F.lit(None).cast("string")
    for name, short in known.items():
        out = F.when(top == name, short).otherwise(out)
    return out


def per_record(rows: DataFrame, fields: list[str], name=lambda f: f) -> DataFrame:
    """One row per record: each field's values in order of alleles, joined by commas with dots for nulls; null if all are null."""
    ordered = F.array_sort(F.collect_list(F.struct("alt_index", *fields)))
    grouped = rows.groupBy("record_ordinal").agg(ordered.alias("_rows"))

    def joined(f: str) -> Column:
        values = F.transform("_rows", lambda r: r[f].cast("string"))
        return F.when(F.exists(values, lambda v: v.isNotNull()), F.array_join(values, ",", "."))

    return grouped.select("record_ordinal", *[joined(f).alias(name(f)) for f in fields])


def info_text(row: DataFrame, fields: list[str], prefix: str) -> Column:
    """``PREFIX_FIELD=values`` parts of the fields that are not null, joined by semicolons."""
    return F.concat_ws(";", *[F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{prefix}_{f}="), F.col(f))) for f in fields])


def without_own_info(info: Column, prefix: str) -> Column:
    """The INFO text without fields of an earlier run; a text without their prefix is not taken apart."""
    kept = F.filter(F.split(info, ";"), lambda x: ~x.rlike(rf"^{prefix}_[A-Z_]+(?:=|$)"))
    return F.when(~info.contains(f"{prefix}_"), info).when(F.size(kept) == 0, ".").otherwise(F.array_join(kept, ";"))


class HeaderConflict(ValueError):
    """The input's header defines one of our fields otherwise."""


def header_lines(header: list[str], prefix: str) -> list[str]:
    """Header with our definitions; ones that are there are used again, and differing ones raise."""
    import re

    out = list(header)
    place = next((i for i, x in enumerate(out) if x.startswith("#CHROM")), len(out))
    for field, number, kind, about in INFO_FIELDS:
        name = f"{prefix}_{field}"
        old = next((x for x in out if x.startswith(f"##INFO=<ID={name},")), None)
        if old is None:
            out.insert(place, f'##INFO=<ID={name},Number={number},Type={kind},Description="{about}">')
            place += 1
        elif not re.match(rf"##INFO=<ID={name},Number={re.escape(number)},Type={kind},", old):
            raise HeaderConflict(f"the header defines {name} differently: {old}")
    return out
