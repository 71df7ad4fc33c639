"""The library's end-to-end jobs: preprocessing, annotation, scoring, averaging over folds, prioritisation."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions import alleles, scoring, text
from genoframe.operators import augment, family, folds, ingest, intervals, lookups, prioritize, regions, validate
from genoframe.sources import bucketed, readers, sinks

#: Populations of the frequency table, and the annotation's names for them.
POPULATIONS = ("afr", "ami", "amr", "asj", "eas", "fin", "mid", "nfe", "sas", "remaining")
VERSION = "1"


def annotate(variants: DataFrame, region_table: DataFrame, genes: DataFrame, elements: DataFrame, frequencies: DataFrame) -> DataFrame:
    """One row per variant row of ``variants(chr, pos, ref, alt, variant_id)`` with its 29 fields.

    ``genes(chrom, start, end, gene_name, gene_id)``; ``elements(chrom, start, end, accession, grp)``;
    ``frequencies(chrom, pos, ref, alt, frequencies)``, a list of (population, frequency) by keys without prefix.
    """
    spans = variants.select(F.col("chr").alias("chrom"), "pos", "ref").distinct().withColumn("v_end", alleles.span_end(F.col("pos"), F.col("ref")))
    labels = regions.annotate(spans, region_table).select("chrom", "pos", "ref", F.col("primary").alias("region_type"), F.col("labels").alias("region_labels"), F.col("gene_ids").alias("region_gene_ids"), "is_coding", "in_promoter")
    hit = intervals.first_overlap(spans, elements, ["chrom", "pos", "ref"], ["accession", "grp"], ["start", "end", "accession"], ("chrom", "pos", "v_end"), ("chrom", "start", "end"))
    near = intervals.nearest(spans, genes.select("chrom", "start", "end", F.struct("gene_id", "gene_name").alias("id")))
    listed = near.groupBy("chrom", "pos").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "distance"))).alias("g"))
    kind = lambda d: F.when(d == 0, "inside").otherwise("near")
    named = F.transform("g", lambda r: F.struct(r["id"]["gene_name"].alias("gene_name"), r["id"]["gene_id"].alias("gene_id"), r["distance"].alias("distance"), kind(r["distance"]).alias("type")))
    listed = listed.select("chrom", "pos", named.alias("nearest_genes"), (F.abs(F.col("g")[0]["distance"]) <= 100_000).alias("gene_within_100kb"))
    af = lookups.flatten_frequencies(frequencies, "frequencies", [f"{p}_adj" for p in POPULATIONS])
    ref, alt = F.col("ref"), F.col("alt")
    base = variants.withColumn("chrom", F.col("chr"))
    out = base.join(labels, ["chrom", "pos", "ref"], "left").join(hit, ["chrom", "pos", "ref"], "left").join(listed, ["chrom", "pos"], "left")
    out = lookups.frequency_lookup(out.withColumn("chrom", alleles.without_chr(F.col("chrom"))), af, lookups.ALLELE)
    return out.select(
        "chr", "pos", "ref", "alt", "variant_id", F.length(ref).alias("ref_length"), F.length(alt).alias("alt_length"), alleles.variant_length(ref, alt).alias("variant_length"), alleles.variant_type(ref, alt).alias("variant_type"),
        "region_type", "region_labels", "region_gene_ids", "is_coding", "in_promoter", F.coalesce("nearest_genes", F.array().cast("array<struct<gene_name:string,gene_id:string,distance:bigint,type:string>>")).alias("nearest_genes"), F.coalesce("gene_within_100kb", F.lit(False)).alias("gene_within_100kb"),
        F.col("accession").alias("ccre_id"), F.col("grp").alias("ccre_group"), "in_ot", *[F.col(f"af_{p}_adj").alias(f"af_{p}") for p in POPULATIONS],
    )


def frequency_table(source: DataFrame) -> DataFrame:
    """``chrom, pos, ref, alt, frequencies`` from files of variants with ``chromosome, position, referenceAllele, alternateAllele,
    alleleFrequencies(populationName, alleleFrequency)``: what the annotation job reads. Frequencies have three decimals, missing ones are 0."""
    entry = lambda e: F.struct(e["populationName"].alias("population"), F.coalesce(F.bround(e["alleleFrequency"], 3), F.lit(0.0)).alias("frequency"))
    named = F.filter("alleleFrequencies", lambda e: e["populationName"].isNotNull())
    return source.select(F.col("chromosome").alias("chrom"), F.col("position").cast("long").alias("pos"), F.col("referenceAllele").alias("ref"), F.col("alternateAllele").alias("alt"), F.coalesce(F.transform(named, entry), F.array().cast("array<struct<population:string,frequency:double>>")).alias("frequencies"))


def score(predictions: DataFrame, distribution: DataFrame, peaks: DataFrame | None = None) -> DataFrame:
    """Adds ``lfc, jsd, active_allele_quantile, ips`` to predictions, and ``in_peak`` if peaks are given.

    ``distribution(value)`` is the thousand-point one of a fold.
    """
    # one row of a thousand numbers
    dist = distribution.agg(F.array_sort(F.collect_list("value")).alias("_dist"))
    both = predictions.crossJoin(F.broadcast(dist))
    lfc = scoring.log2_fold_change(F.col("ref_logcounts"), F.col("alt_logcounts"))
    jsd = scoring.jensen_shannon_distance(F.col("ref_logits"), F.col("alt_logits"))
    quantile = scoring.active_allele_quantile(F.col("_dist"), F.col("ref_logcounts"), F.col("alt_logcounts"))
    out = both.withColumns({"lfc": lfc, "jsd": jsd, "active_allele_quantile": quantile}).drop("_dist").withColumn("ips", scoring.integrative_score(F.col("lfc"), F.col("jsd"), F.col("active_allele_quantile")))
    if peaks is None:
        return out
    spans = out.select("chrom", "pos", "ref").distinct().withColumn("v_end", alleles.span_end(F.col("pos"), F.col("ref")))
    return out.join(intervals.overlaps_any(spans, peaks, ["chrom", "pos", "ref"], "in_peak", ("chrom", "pos", "v_end")), ["chrom", "pos", "ref"], "left")


def average_folds(spark: SparkSession, paths: list[str], keys: list[str], columns: list[str]) -> DataFrame:
    """Means over fold tables with headers; every fold must have the same keys."""
    read = lambda k, p: spark.read.option("sep", "\t").option("header", True).option("inferSchema", True).csv(p).withColumn("fold", F.lit(k))
    rows = read(0, paths[0])
    for k, p in enumerate(paths[1:], 1):
        rows = rows.unionByName(read(k, p))
    tagged = rows.withColumn("_key", F.to_json(F.struct(*keys)))
    folds.require_same_members(tagged, "fold", "_key", 0)
    return folds.average(rows, keys, columns, len(paths))


def summarize_folds(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``variant_id, counts_log2fc, profile_l1``: means of the values there are, over folds with equal ids."""
    rows = readers.read_fold_scores(spark, paths[0]).withColumn("fold", F.lit(0))
    for k, p in enumerate(paths[1:], 1):
        rows = rows.unionByName(readers.read_fold_scores(spark, p).withColumn("fold", F.lit(k)))
    folds.require_same_members(rows, "fold", "variant_id", 0)
    return rows.groupBy("variant_id").agg(*[folds.mean_of_present(F.col(c)).alias(c) for c in ("counts_log2fc", "profile_l1")])


def prioritize_variants(scores: DataFrame, models: list[str]) -> DataFrame:
    """Pivoted, prioritised and with the headline model; scores hold one row per variant and model."""
    index = ["variant_id", "chr", "pos", "ref", "alt", "region_type", "in_promoter"]
    wide = prioritize.pivot(scores, index, models)
    return prioritize.top_model(prioritize.prioritize(wide, models, F.col("in_promoter")), models)


def preprocess(spark: SparkSession, path: str, fasta: str, region_table: DataFrame, out: str, categories=regions.DEFAULT_CATEGORIES, fmt: str = "auto", genome: str = "GRCh38", width: int = 2114, phenopacket: str | None = None) -> dict:
    """Validates an input, writes occurrences, canonical and invalid variants, category folders and, with a phenopacket, the
    family's evidence; returns and writes the manifest, which comes last. A run over the same input changes nothing.
    """
    kind = readers.resolve_format(path, fmt)
    context = None
    if phenopacket is not None:
        if kind != "vcf":
            raise ValueError("a family needs a VCF")
        context = family.load_context(phenopacket, path)
    regions.checked(categories)
    target = next(m["sample"] for m in context["members"] if m["relationship"] == "PROBAND") if context else None
    rows = readers.vcf_occurrences(spark, path, genome, target) if kind == "vcf" else readers.tsv_occurrences(spark, path, genome)
    digest, size = readers.text_digest(spark, path)
    mark = hashlib.sha256(json.dumps([digest, readers.files_mark(spark, fasta), VERSION, genome, width, target]).encode()).hexdigest()
    checked = validate.validate(rows.drop("canonical_variant_id").withColumnRenamed("chr", "chrom"), readers.read_fasta_chunks(spark, fasta), width)
    named = ingest.with_canonical_id(checked, name="canonical_variant_id").withColumnRenamed("chrom", "chr")
    sinks.write_once(named, f"{out}/occurrences", mark)
    done = spark.read.schema(named.schema).parquet(f"{out}/occurrences")
    valid = done.where("status = 'PENDING'")
    canonical = valid.select("canonical_variant_id", "genome", "chr", "pos", "ref", "alt").distinct()
    bad = done.where("status <> 'PENDING'").withColumn("error_message", F.col("error_code"))
    sinks.write_once(canonical, f"{out}/canonical", mark)
    sinks.write_once(bad, f"{out}/invalid", mark)
    sinks.write_tsv(valid.select("chr", "pos", "ref", "alt", "variant_id"), f"{out}/valid")
    sinks.write_tsv(bad, f"{out}/invalid_table", header=True)
    labelled = regions.annotate(valid.withColumnRenamed("chr", "chrom"), region_table)
    whole = valid.withColumnRenamed("chr", "chrom").join(labelled, ["chrom", "pos", "ref"]).select(F.col("chrom").alias("chr"), "pos", "ref", "alt", "variant_id", "labels")
    routed = regions.route(whole, categories).drop("labels")
    counts = sinks.write_categories(routed, f"{out}/regions", categories)
    if context:
        sinks.write_tsv(family_evidence(spark, path, context), f"{out}/family", header=True, compression="gzip")
    good = F.col("status") == "PENDING"
    totals = done.agg(
        F.count(F.lit(1)).alias("alt_occurrence_count"), F.count_if(good).alias("valid_occurrence_count"), F.count_if(~good & (F.col("status") != "UNSUPPORTED")).alias("invalid_occurrence_count"),
        F.count_if(F.col("status") == "UNSUPPORTED").alias("unsupported_occurrence_count"), F.count_if(F.coalesce(F.col("error_code") == "NOT_CARRIED_BY_TARGET", F.lit(False))).alias("target_excluded_occurrence_count"),
        F.count_distinct(F.when(good, F.col("canonical_variant_id"))).alias("unique_canonical_variants"),
    ).first().asDict()
    records = (readers.read_vcf_records(spark, path)[1] if kind == "vcf" else rows).count()
    manifest = {"source_format": kind, "input_digest": digest, "input_size_bytes": size, "record_count": records, **totals, "duplicate_canonical_occurrences": max(0, totals["valid_occurrence_count"] - totals["unique_canonical_variants"]), "categories": counts, "fingerprint": mark}
    sinks.write_manifest(spark, f"{out}/manifest.json", manifest)
    return manifest


def family_evidence(spark: SparkSession, path: str, context: dict) -> DataFrame:
    """Evidence of each allele that the proband carries, with cohort counts of the INFO field."""
    header, records = readers.read_vcf_records(spark, path)
    samples = readers.samples_of(header)
    members = context["members"]
    family.require_samples(members, samples)
    rows = ingest.split_alts(records.where("alt_raw <> '.'"))
    info = lambda k: F.nullif(F.regexp_extract("info", rf"(?:^|;){k}=([^;]+)", 1), F.lit(""))
    own = lambda k: F.get(F.split(info(k), ","), F.col("alt_index") - 1)
    rows = rows.withColumns({"cohort_ac": own("AC"), "cohort_an": info("AN"), "cohort_af": own("AF")})
    people = F.array(*[F.struct(F.lit(k).alias("member"), *[F.lit(m[c]).alias(c) for c in ("individual", "sample", "relationship", "affected")], readers.call_of(samples, m["sample"]).alias("call")) for k, m in enumerate(members)])
    calls = rows.withColumn("m", F.explode(people)).select("record_ordinal", "alt_index", "chrom", "pos", "ref", "alt", "cohort_ac", "cohort_an", "cohort_af", "m.*").select("*", "call.*")
    keys = ["record_ordinal", "alt_index", "chrom", "pos", "ref", "alt", "cohort_ac", "cohort_an", "cohort_af"]
    out = ingest.with_canonical_id(family.evidence(calls, keys), name="canonical_variant_id")
    roles = [f"{r}_{x}" for r in ("proband", "mother", "father") for x in ("id", "sample", "gt", "ad", "dp", "gq")]
    return out.select("canonical_variant_id", *keys[2:], *roles, "inheritance", "affected_carriers", "unaffected_carriers", "shared_siblings", "quality_flags", "member_genotypes_json")


def annotation_fields(results: DataFrame, models: list[dict], model_scores: bool = True) -> DataFrame:
    """``record_ordinal`` and a text for each INFO field, from result rows; columns that the results lack are null.

    Rows without a result have a status and an error only.
    """
    there = set(results.columns)
    get = lambda c: F.col(c) if c in there else F.lit(None).cast("string")
    number = lambda c: get(c).cast("double")
    models = augment.short_ids(models)
    has = F.col("result_variant_id").isNotNull()
    of = {
        "PRIORITIZED": F.coalesce(get("prioritized").cast("boolean"), F.lit(False)).cast("int"),
        "MAX_ABS_LOGFC": scoring.max_abs(F.array(*[number(f"{m['column_prefix']}_logfc") for m in models])) if models else F.lit(None).cast("double"),
        "TOP_MODEL": augment.top_short_id(get("most_active_celltype"), models),
        "REGION": get("region_type"), "NEAREST_GENE": text.first_gene(get("nearest_genes")), "CCRE": get("ccre"), "GNOMAD_AF": number("af_global"),
        "CADD_PHRED": number("cadd_phred"), "AM_SCORE": number("am_pathogenicity"), "AM_CLASS": get("am_class"), "REVEL": number("revel_score"),
    }
    rows = results.select("record_ordinal", "alt_index", augment.status(get("status"), F.col("result_variant_id")).alias("STATUS"), get("error_code").alias("ERROR"), *[F.when(has, c).alias(f) for f, c in of.items()])
    out = augment.per_record(rows, ["STATUS", "ERROR", *of])
    if not model_scores or not models:
        return out

    def entry(m: dict):
        p = m["column_prefix"]
        return text.model_score_entry(F.col("alt_index"), F.lit(m["short_id"]), *[number(f"{p}_{x}") for x in ("logfc", "jsd", "active_allele_quantile")], *[get(f"{p}_{x}").cast("boolean") for x in ("in_peak", "prioritized")])

    entries = F.when(has, F.array_compact(F.array(*[entry(m) for m in models]))).otherwise(F.array().cast("array<string>"))
    ordered = F.array_sort(F.collect_list(F.struct("alt_index", entries.alias("e"))))
    scores = results.groupBy("record_ordinal").agg(F.array_join(F.flatten(F.transform(ordered, lambda r: r["e"])), ",").alias("_e"))
    return out.join(scores.select("record_ordinal", F.nullif("_e", F.lit("")).alias("MODEL_SCORE")), "record_ordinal")


def export_vcf(spark: SparkSession, vcf: str, buckets: str, models: list[dict], manifest: dict, out: str, prefix: str, model_scores: bool = True) -> dict:
    """Writes the input VCF with the results' fields; the input must be the manifest's, and every allele must have one result row."""
    digest, _ = readers.text_digest(spark, vcf)
    if digest != manifest["input_digest"]:
        raise augment.Misaligned(f"{vcf} is not the file that was ingested")
    header, records = readers.read_vcf_records(spark, vcf)
    work = f"{out}.work"
    keys = bucketed.write(ingest.split_alts(records.where("alt_raw <> '.'")).select(*augment.KEY), f"{work}/alleles", augment.KEY)
    n_records, n_alts = records.count(), keys.count()
    if (n_records, n_alts) != (manifest["record_count"], manifest["alt_occurrence_count"]):
        raise augment.Misaligned(f"{n_records} records and {n_alts} alleles; the manifest has {manifest['record_count']} and {manifest['alt_occurrence_count']}")
    # moved once, to the alleles' buckets: neither the checks nor the merge move them again
    results = ingest.require_unique(bucketed.write(readers.read_buckets(spark, buckets).drop("bucket"), f"{work}/results", augment.KEY), *augment.KEY)
    merged = augment.merge(keys, results)
    sinks.write_augmented_vcf(augment.header_lines(header, prefix), records, annotation_fields(merged, models, model_scores), out, prefix)
    written = spark.read.text(out).where("NOT startswith(value, '#')").count()
    if written != n_records:
        raise augment.Misaligned(f"{written} records were written of {n_records}")
    done = {"records": n_records, "alleles": n_alts, "input_digest": digest}
    sinks.write_manifest(spark, f"{out}.manifest.json", done)
    sinks.delete(spark, work)
    return done


def lookup_scores(spark: SparkSession, variants: DataFrame, root: str) -> tuple[DataFrame, dict]:
    """(variant rows with the scores of every matching transcript, statistics) from a table partitioned by chromosome.

    The chromosomes asked for are pushed to the scan as partition filters; the input's own chromosome text is kept.
    """
    asked = variants.withColumn("chrom", alleles.with_chr(F.col("chr")))
    chromosomes = sorted(r.chrom for r in asked.select("chrom").where("chrom IS NOT NULL").distinct().collect())
    columns = ["genome", "uniprot_id", "transcript_id", "protein_variant", "am_pathogenicity", "am_class"]
    table = lookups.prune_partitions(spark.read.parquet(root), chromosomes).select(F.col("CHROM").alias("chrom"), F.col("POS").cast("long").alias("pos"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), *columns)
    joined = lookups.left_lookup(asked, table, columns)
    stats = lookups.lookup_stats(ingest.with_canonical_id(joined), "transcript_id", "canonical_id").first().asDict()
    return joined.select(*variants.columns, *columns), stats
