"""Pedigrees, genotype evidence of family members and inheritance."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoframe.functions import text

MIN_DP, MIN_GQ = 10, 20
ROLES = ("PROBAND", "MOTHER", "FATHER", "SIBLING", "RELATIVE")


def missing_parent(p: Column) -> Column:
    return p.isNull() | p.isin("", "0")


def relationships(pedigree: DataFrame, proband: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``relationship`` to ``pedigree(person, mother, father)``, by family if ``keys`` name one.

    Siblings share both parents, which must be known. ``proband`` names a boolean column. Pedigrees are one step deep.
    """
    own = pedigree.where(F.col(proband)).select(*keys, F.col("person").alias("_p"), F.when(~missing_parent(F.col("mother")), F.col("mother")).alias("_m"), F.when(~missing_parent(F.col("father")), F.col("father")).alias("_f"))
    # one proband per family
    joined = pedigree.join(own, list(keys), "left") if keys else pedigree.crossJoin(F.broadcast(own))
    both = F.col("_m").isNotNull() & F.col("_f").isNotNull() & (F.col("mother") == F.col("_m")) & (F.col("father") == F.col("_f"))
    kind = F.when(F.col("person") == F.col("_p"), "PROBAND").when(F.col("person") == F.col("_m"), "MOTHER").when(F.col("person") == F.col("_f"), "FATHER").when(both, "SIBLING").otherwise("RELATIVE")
    return joined.withColumn("relationship", kind).drop("_p", "_m", "_f")


def carries(gt: Column, alt_index: Column) -> Column:
    return F.coalesce(F.array_contains(gt, alt_index.cast("int")), F.lit(False))


def confident_reference(gt: Column, dp: Column, gq: Column) -> Column:
    """All alleles are the reference, with depth and quality; nulls are not confident, nor is an empty genotype."""
    return F.coalesce((F.size(gt) > 0) & F.forall(gt, lambda a: F.coalesce(a == 0, F.lit(False))) & (F.coalesce(dp, F.lit(-1)) >= MIN_DP) & (F.coalesce(gq, F.lit(-1)) >= MIN_GQ), F.lit(False))


def inheritance(mother_carries: Column, father_carries: Column, mother_reference: Column, father_reference: Column) -> Column:
    """Direct evidence of the parents; it never asserts that an allele is new."""
    no = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(no(mother_carries) & no(father_carries), "BIPARENTAL")
        .when(no(mother_carries), "MATERNAL")
        .when(no(father_carries), "PATERNAL")
        .when(no(mother_reference) & no(father_reference), "PARENTS_REFERENCE")
        .otherwise("UNRESOLVED")
    )


def _joined(condition: Column, value: Column, order: Column) -> Column:
    rows = F.array_sort(F.collect_list(F.when(condition, F.struct(order.alias("o"), value.alias("v")))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), ",")


def evidence(calls: DataFrame, keys: list[str], order: str = "member") -> DataFrame:
    """One row per key (record and ``alt_index`` among them) whose proband carries the allele.

    ``calls``: a row per key and member with ``individual, sample, relationship, affected, gt, phased, ad, dp, gq``. Each
    role's genotype, depth and quality, inheritance, comma lists of carriers in ``order``, quality flags, and all members as JSON.
    """
    own = carries(F.col("gt"), F.col("alt_index"))
    c = calls.withColumn("carries", own).withColumn("reference", confident_reference(F.col("gt"), F.col("dp"), F.col("gq"))).withColumn("gt_text", text.format_gt(F.col("gt"), F.col("phased")))
    role = lambda r, col: F.max(F.when(F.col("relationship") == r, F.col(col)))
    o, who = F.col(order), F.col("individual")
    low = lambda x, least: F.coalesce(x < least, F.lit(True))
    flags = F.array_compact(F.array(F.when(low(F.col("dp"), MIN_DP), F.concat(who, F.lit(":LOW_DP"))), F.when(low(F.col("gq"), MIN_GQ), F.concat(who, F.lit(":LOW_GQ")))))
    flagged = F.col("carries") & (F.size(flags) > 0)
    members = F.struct(o.alias("o"), F.struct(who.alias("individual_id"), F.col("sample").alias("sample_id"), "relationship", F.col("affected").alias("affected_status"), F.col("gt_text").alias("gt"), "dp", "gq", F.col("carries").alias("carries_alt")).alias("m"))
    columns = []
    for r in ("PROBAND", "MOTHER", "FATHER"):
        columns += [role(r, x).alias(f"{r.lower()}_{y}") for x, y in (("individual", "id"), ("sample", "sample"), ("gt_text", "gt"), ("dp", "dp"), ("gq", "gq"))]
        columns.append(F.max(F.when(F.col("relationship") == r, text.format_values(F.col("ad")))).alias(f"{r.lower()}_ad"))
    out = c.groupBy(*keys).agg(
        *columns,
        inheritance(role("MOTHER", "carries"), role("FATHER", "carries"), role("MOTHER", "reference"), role("FATHER", "reference")).alias("inheritance"),
        _joined(F.col("carries") & (F.col("affected") == "AFFECTED"), who, o).alias("affected_carriers"),
        _joined(F.col("carries") & (F.col("affected") == "UNAFFECTED"), who, o).alias("unaffected_carriers"),
        _joined(F.col("carries") & (F.col("relationship") == "SIBLING"), who, o).alias("shared_siblings"),
        _joined(flagged, F.array_join(flags, ","), o).alias("quality_flags"),
        F.to_json(F.transform(F.array_sort(F.collect_list(members)), lambda r: r["m"]), {"ignoreNullFields": "false"}).alias("member_genotypes_json"),
        role("PROBAND", "carries").alias("_carried"),
    )
    return out.where("_carried").drop("_carried")


def load_context(path: str, vcf: str) -> dict:
    """Family context of a phenopacket JSON: proband, members with relationship, sample and status.

    The entry of ``files`` whose base name is the VCF's, else the only entry, maps individuals to samples.
    """
    with open(path, encoding="utf-8") as f:
        packet = json.load(f)
    proband = ((packet.get("proband") or {}).get("subject") or {}).get("id")
    if not packet.get("id") or not proband:
        raise ValueError("a family needs an id and a proband with a subject id")
    files = packet.get("files") or []
    named = [x for x in files if os.path.basename(str(x.get("uri", ""))) == os.path.basename(vcf)] or (files if len(files) == 1 else [])
    if not named:
        raise ValueError(f"no file of the family is {os.path.basename(vcf)}")
    samples = named[0].get("individualToFileIdentifiers") or {}
    if proband not in samples:
        raise ValueError(f"the proband {proband} has no sample")
    gone = (None, "", 0, "0")
    persons = {p["individualId"]: p for p in (packet.get("pedigree") or {}).get("persons", [])}
    own = persons.get(proband, {})
    mother, father = own.get("maternalId"), own.get("paternalId")
    members = []
    for who, p in {proband: own, **persons}.items():
        if who not in samples:
            continue
        parents = p.get("maternalId"), p.get("paternalId")
        if who == proband:
            kind = "PROBAND"
        elif mother not in gone and who == mother:
            kind = "MOTHER"
        elif father not in gone and who == father:
            kind = "FATHER"
        elif parents == (mother, father) and not {mother, father} & set(gone):
            kind = "SIBLING"
        else:
            kind = "RELATIVE"
        members.append({"individual": who, "sample": samples[who], "relationship": kind, "affected": p.get("affectedStatus", "MISSING"), "sex": p.get("sex")})
    return {"family_id": packet["id"], "proband": proband, "members": members}


def require_samples(members: list[dict], header_samples: list[str]) -> None:
    lost = sorted(m["sample"] for m in members if m["sample"] not in set(header_samples))
    if lost:
        raise ValueError(f"samples not in the header: {', '.join(lost)}")
