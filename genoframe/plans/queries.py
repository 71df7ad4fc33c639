"""Registered queries: each applies an operator to the genomic views of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions import alleles, scoring, sequence, text
from genoframe.operators import augment, family, folds, inference, ingest, intervals, lookups, motifs, ordinal, prioritize, regions, validate
from genoframe.plans.views import KEYS, MODELS, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Contigs in header order.
CONTIGS = [f"chr{i}" for i in range(1, 24)] + ["chrX", "chrM"]
SPAN = ["chrom", "pos", "ref"]


def query(f: Callable[[Views], DataFrame]):
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
    return f


def rounded(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def listed(c: str) -> Column:
    return F.array_join(c, ",")


def spans(v: Views) -> DataFrame:
    return v.variants.select(*SPAN).distinct().withColumn("v_end", alleles.span_end(F.col("pos"), F.col("ref")))


# ---- ingest


@query
def multiallelic_split(v):
    return ingest.split_alts(v.variants).select(*KEYS, "alt_index", "alt")


@query
def symbolic_filter(v):
    return ingest.split_alts(v.variants).where(alleles.is_sequence_alt(F.col("ref"), F.col("alt"))).select(*KEYS, "alt")


@query
def alt_error_code(v):
    return v.occurrences.select(*KEYS, "alt_index", "alt", "error_code", "status")


@query
def sortedness_violations(v):
    ordered = ordinal.with_ordinal(v.variants, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    ranked = ordered.withColumn("rid", alleles.contig_rank(F.col("chrom"), CONTIGS)).select("record_ordinal", "chrom", "rid", "pos")
    return ordinal.descents(ranked, "record_ordinal", "rid", "pos").select("record_ordinal", "chrom", "pos")


@query
def variant_type(v):
    ref, alt = F.col("ref"), F.col("alt")
    return v.canonical_rows.select("canonical_id", F.length(ref).alias("ref_length"), F.length(alt).alias("alt_length"), alleles.variant_length(ref, alt).alias("variant_length"), alleles.variant_type(ref, alt).alias("variant_type"))


@query
def canonical_dedup(v):
    return ingest.canonical(v.occurrences)


@query
def ingest_counts(v):
    return ingest.counts(v.variants, v.occurrences)


@query
def target_carrier(v):
    rows = v.family.where("member = 1").withColumn("alt_index", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("error_code", F.lit(None).cast("string")).withColumn("status", F.lit(alleles.PENDING))
    return ingest.mask_target(rows).select("record", "alt_index", "status", "error_code")


# ---- intervals and regions


@query
def region_annotation(v):
    out = regions.annotate(v.variants, v.regions)
    return out.select(*SPAN, listed("labels").alias("labels"), listed("gene_ids").alias("gene_ids"))


@query
def region_primary(v):
    return regions.annotate(v.variants, v.regions).select(*SPAN, F.col("primary").alias("primary_label"), "is_coding", "in_promoter")


@query
def region_routing(v):
    return regions.route(regions.annotate(v.variants, v.regions), tuple(regions.CATEGORIES)).select(*SPAN, "category")


@query
def region_routing_counts(v):
    return regions.route_counts(regions.route(regions.annotate(v.variants, v.regions)))


@query
def ccre_overlap(v):
    elements = v.regions.select("chrom", "start", "end", F.concat(F.lit("EH"), F.col("rid").cast("string")).alias("accession"), F.col("feature").alias("grp"))
    return intervals.first_overlap(spans(v), elements, SPAN, ["accession", "grp"], ["start", "end", "accession"], ("chrom", "pos", "v_end"), ("chrom", "start", "end"))


@query
def in_peak(v):
    peaks = v.regions.where("feature = 'cds'").select("chrom", "start", "end")
    return intervals.overlaps_any(spans(v), peaks, SPAN, "in_peak", ("chrom", "pos", "v_end"))


@query
def nearest_genes(v):
    genes = v.genes.select("chrom", "start", "end", F.col("gene_id").alias("id"))
    out = intervals.nearest(v.variants, genes, 5)
    near = F.expr("min(abs(distance)) OVER (PARTITION BY chrom, pos)") <= 100_000
    return out.select("chrom", "pos", "rank", F.col("id").alias("gene_id"), F.col("distance").alias("signed_distance"), near.alias("within_100kb"))


@query
def range_fetch(v):
    track = v.variants.groupBy("chrom", "pos").agg(F.max("l_quantity").cast("int").alias("value"))
    out = intervals.per_base(v.regions.withColumnRenamed("rid", "id"), track)
    return out.select(F.col("id").alias("rid"), F.array_join(F.transform("values", lambda x: x.cast("string")), ",", "nan").alias("values"))


@query
def motif_hits(v):
    hits = v.regions.withColumn("size", ((F.col("end") - F.col("start")) / 20).cast("long")).where("size >= 10").select((F.col("rid") % 100).alias("row"), (1000 + F.col("rid") * 7 % 120).alias("start"), F.col("size"), F.col("feature").alias("motif"))
    hits = hits.withColumn("end", F.col("start") + F.col("size")).drop("size")
    rows = v.table("supplier").select((F.col("s_suppkey") % 100).alias("row"), "s_suppkey")
    met = motifs.overlapping(rows, hits, ["s_suppkey"], ["row"], F.col("s_suppkey") % 3 + 1)
    return met.select("s_suppkey", listed("motifs").alias("motifs"))


# ---- lookups


@query
def score_lookup_left(v):
    out = lookups.left_lookup(v.canonical_rows.select(*KEYS, *lookups.ALLELE, "canonical_id"), v.missense, ["transcript_id", "score", "class"])
    return out.select(*KEYS, "canonical_id", "transcript_id", "score", "class")


@query
def lookup_stats(v):
    return lookups.lookup_stats(lookups.left_lookup(v.canonical_rows, v.missense, ["transcript_id"]), "transcript_id", "canonical_id")


def _frequency_lists(v: Views) -> DataFrame:
    entry = F.struct("ts", "event_id", F.col("event_type").alias("population"), (F.col("value") / 1024).alias("frequency"))
    rows = v.table("events").groupBy("user_id").agg(F.array_sort(F.collect_list(entry)).alias("frequencies"))
    return lookups.flatten_frequencies(rows, "frequencies", list(MODELS))


@query
def af_flatten(v):
    return _frequency_lists(v)


@query
def af_lookup(v):
    customers = v.table("customer").select(F.col("c_custkey").alias("user_id"))
    return lookups.frequency_lookup(customers, _frequency_lists(v), ["user_id"])


@query
def snv_indel_lookup(v):
    table = v.missense
    kind = lookups.snv_or_indel(F.col("ref"), F.col("alt"))
    out = lookups.two_table_lookup(ingest.canonical(v.occurrences), table.where(kind == "SNV"), table.where(kind == "INDEL"), "score", "transcript_id")
    return out.select("canonical_id", "kind", "score")


@query
def resume_antijoin(v):
    done = ingest.with_canonical_id(v.missense)
    return lookups.not_done(ingest.canonical(v.occurrences), done, "canonical_id").select("canonical_id")


# ---- gene models


def _introns(v: Views) -> DataFrame:
    return regions.introns(v.exons, ("start", "end", "l_partkey"))


@query
def derive_introns(v):
    return _introns(v).select("tx", "start", "end")


@query
def derive_splice_sites(v):
    return regions.splice_sites(_introns(v)).select("tx", "kind", "start", "end")


@query
def derive_splice_regions(v):
    return regions.splice_regions(_introns(v)).select("tx", "side", "start", "end")


@query
def derive_promoters(v):
    return regions.promoters(v.genes).select("gene_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query
def region_table_union(v):
    return regions.region_table(v.exons, v.genes)


@query
def feature_histogram(v):
    return regions.region_table(v.exons, v.genes).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


@query
def gff_lookup(v):
    tx = v.table("orders").select(F.lit("mRNA").alias("feature"), F.concat(F.lit("ID=transcript:T"), F.col("o_orderkey").cast("string"), F.lit(";Parent=gene:G"), F.col("o_custkey").cast("string"), F.lit(";biotype=own")).alias("attributes"))
    gene = v.table("customer").where("c_custkey % 5 <> 0").select(F.lit("gene").alias("feature"), F.concat(F.lit("ID=gene:G"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit(";Name="), F.col("c_name"))).otherwise(""), F.lit(";biotype="), F.col("c_mktsegment")).alias("attributes"))
    return regions.transcripts_of(tx.unionByName(gene))


@query
def gff_regions(v):
    return regions.regions_of(v.gene_model)


@query
def peaks_windows(v):
    from genoframe.sources.readers import peak_windows

    peaks = v.regions.select(F.col("rid").alias("id"), "start", "end", (F.col("rid") % 50).alias("summit_offset"))
    both = [peak_windows(p).select(F.lit(name).alias("variant"), "id", "summit_pos", "window_start", "window_end") for name, p in (("summits", peaks), ("middles", peaks.withColumn("summit_offset", F.lit(None).cast("long"))))]
    return both[0].unionByName(both[1])


# ---- sequences


def _validated(v: Views) -> DataFrame:
    return validate.validate(v.sequence_variants, v.contigs.where("contig % 17 <> 0"), 40, "id")


@query
def validate_variants(v):
    return _validated(v).select("id", "error_code", "status")


@query
def validation_summary(v):
    return validate.summary(_validated(v))


@query
def allele_windows(v):
    rows = v.sequence_variants.join(v.contigs, F.col("id") == F.col("contig")).withColumn("seq", F.translate("seq", "acgtn", "ACGTN"))
    clean = rows.withColumn("ref", F.expr("substring(seq, CAST(pos AS int), 2)")).withColumn("alt", F.expr("CASE WHEN id % 3 = 0 THEN 'A' ELSE 'GATTACA' END")).where("rlike(ref, '^[ACGTN]+\\\\z')")
    ref_seq, alt_seq = sequence.allele_windows(F.expr("regexp_replace(seq, '[^ACGTN]', 'N')"), F.col("pos"), F.col("ref"), F.col("alt"), 64)
    return clean.select("id", ref_seq.alias("ref_seq"), alt_seq.alias("alt_seq"))


@query
def alt_window(v):
    rows = v.sequence_variants.join(v.contigs, F.col("id") == F.col("contig"))
    out = sequence.alt_window(F.col("seq"), F.col("pos"), F.col("ref"), F.col("alt"), 40)
    return rows.select("id", out.alias("alt_seq"), F.length(out).alias("length"))


@query
def center_slice(v):
    seqs = v.contigs.select(F.lit("sequence").alias("kind"), F.col("contig").alias("id"), sequence.center_slice(F.col("seq"), 200, 50).alias("slice"))
    tracks = v.table("embeddings").select(F.lit("track").alias("kind"), F.col("vec_id").alias("id"), F.array_join(F.transform(sequence.center_slice_array(F.col("embedding"), 64, 8), lambda x: F.floor(x.cast("double") * 1000).cast("string")), ",").alias("slice"))
    return seqs.unionByName(tracks)


@query
def one_hot_counts(v):
    counts = [sequence.base_count(F.col("seq"), b).alias(f"n_{b.lower()}") for b in "ACGT"]
    known = sum((sequence.base_count(F.col("seq"), b) for b in "ACGT"), F.lit(0))
    return v.contigs.select(F.col("contig").alias("id"), *counts, (F.length("seq") - known).alias("n_other"))


# ---- scores


def _peaks(v: Views) -> DataFrame:
    return folds.distribution(v.table("events"), "value")


@query
def peak_distribution(v):
    return _peaks(v)


def _sums(v: Views) -> DataFrame:
    return v.logit_pairs.withColumn("ref_sum", scoring.total(F.col("ref"))).withColumn("alt_sum", scoring.total(F.col("alt")))


@query
def score_lfc(v):
    return _sums(v).select("vec_id", rounded(scoring.log2_fold_change(F.col("ref_sum"), F.col("alt_sum"))).alias("lfc"))


@query
def score_jsd(v):
    return v.logit_pairs.select("vec_id", rounded(scoring.jensen_shannon_distance(F.col("ref"), F.col("alt"))).alias("jsd"))


def _quantiles(v: Views) -> DataFrame:
    dist = _peaks(v).agg(F.array_sort(F.collect_list("value")).alias("dist"))
    # the distribution is one row of a thousand numbers
    both = _sums(v).crossJoin(F.broadcast(dist))
    scale = lambda c: F.abs(F.col(c)) * 20
    return both.withColumn("quantile", scoring.active_allele_quantile(F.col("dist"), scale("ref_sum"), scale("alt_sum"))).drop("dist")


@query
def score_quantile(v):
    return _quantiles(v).select("vec_id", rounded("quantile").alias("quantile"))


@query
def score_ips(v):
    lfc, jsd = scoring.log2_fold_change(F.col("ref_sum"), F.col("alt_sum")), scoring.jensen_shannon_distance(F.col("ref"), F.col("alt"))
    return _quantiles(v).select("vec_id", rounded(scoring.integrative_score(lfc, jsd, F.col("quantile"))).alias("ips"))


@query
def profile_l1(v):
    return v.logit_pairs.select("vec_id", rounded(scoring.counts_log2fc(F.col("ref"), F.col("alt"))).alias("counts_log2fc"), rounded(scoring.profile_l1(F.col("ref"), F.col("alt"))).alias("profile_l1"))


@query
def counts_profile(v):
    profile = scoring.counts_profile(F.col("embedding"), (F.col("label") % 3).cast("double"))
    return v.table("embeddings").select("vec_id", F.posexplode(profile).alias("bin", "value")).select("vec_id", "bin", rounded("value").alias("value"))


@query
def attribution_flatten(v):
    cut = lambda x: F.when(F.abs(x) < 0.05, 0.0).otherwise(x.cast("double"))
    rows = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.transform(F.slice("embedding", i * 4 + 1, 4), cut))
    return v.table("embeddings").select("vec_id", rows.alias("rows")).select("vec_id", sequence.attribution_sequence(F.col("rows")).alias("sequence"), rounded(scoring.total(sequence.attribution_sums(F.col("rows")))).alias("contribution"))


# ---- folds and ranking


@query
def fold_average(v):
    scores = v.model_scores.where("NOT (user_id % 10 = 0 AND model_id = 'view')")
    return folds.average(scores, ["user_id"], ["logfc"], 5).select("user_id", rounded("logfc").alias("score"), "n_folds")


@query
def fold_geomean(v):
    scores = v.model_scores.withColumn("pval", F.col("logfc") + 1)
    return folds.average(scores, ["user_id"], ["pval"], 5).select("user_id", rounded("pval").alias("pval_like"))


@query
def fold_mean_skipnull(v):
    holes = F.when((F.col("user_id") % 4 != 0) | (F.col("model_id") != "click"), F.when(F.col("user_id") % 15 != 0, F.col("logfc")))
    return v.model_scores.withColumn("x", holes).groupBy("user_id").agg(rounded(folds.mean_of_present(F.col("x"))).alias("mean"))


@query
def fold_membership(v):
    scores = v.model_scores.where("NOT (user_id % 7 = 0 AND model_id = 'view') AND NOT (user_id % 5 = 0 AND model_id = 'click')")
    return folds.membership(scores.select(F.col("model_id").alias("fold"), "user_id"), "fold", "user_id", "click")


def _weights():
    """A made-up model: multipliers that depend on position and base alone."""
    import numpy as np

    return lambda own, backgrounds: np.broadcast_to((np.arange(own.shape[1])[:, None] * 7 + np.arange(4) * 3) % 11 - 5.0, backgrounds.shape)


@query
def hypothetical_contributions(v):
    """Of the first 24 letters of every contig; the background is the window read backwards."""
    ref = F.expr("regexp_replace(substring(seq, 1, 24), '[^ACGT]', 'N')")
    windows = v.contigs.where("length(seq) >= 24").select(F.col("contig").alias("id"), ref.alias("ref_seq"), ref.alias("alt_seq"), F.lit(None).cast("string").alias("window_error"))
    made = inference.contribute(windows, _weights, shuffles=2, shuffle=lambda s, _: s[::-1])
    rows = made.select("id", F.posexplode(F.arrays_zip("ref_hypothetical", "ref_observed")).alias("position", "r"))
    return rows.select("id", "position", *[F.col("r.ref_hypothetical")[k].alias(b) for k, b in enumerate("acgt")], F.col("r.ref_observed").alias("observed"))


@query
def array_fold_mean(v):
    return folds.array_mean(v.table("embeddings"), ["label"], "embedding").select("label", "bin", rounded("mean").alias("mean"))


@query
def score_pivot(v):
    wide = prioritize.pivot(v.model_scores, ["user_id"], list(MODELS), unique=False)
    return wide.select("user_id", *[rounded(f"{x}_{m}").alias(f"{x}_{m}") for m in MODELS for x in ("logfc", "active_allele_quantile")], *[f"in_peak_{m}" for m in MODELS])


@query
def prioritized_models(v):
    return v.prioritized.select("user_id", *[f"prioritized_{m}" for m in MODELS], "prioritized")


QUERIES["prioritize"] = QUERIES.pop("prioritized_models")


@query
def top_model(v):
    return prioritize.top_model(v.prioritized, list(MODELS)).select("user_id", "top_model", rounded("top_logfc").alias("top_logfc"))


@query
def max_abs_score(v):
    values = F.array(*[F.when((F.col("user_id") % 6 != 0) | F.lit(m != "click"), F.col(f"logfc_{m}")) for m in MODELS])
    return v.prioritized.select("user_id", rounded(scoring.max_abs(values)).alias("max_abs"))


# ---- families


def _calls(v: Views) -> DataFrame:
    who = F.col("member")
    pick = lambda *names: F.element_at(F.array(*map(F.lit, names)), who)
    rows = v.family.withColumn("alt_index", F.explode(F.array(F.lit(1), F.lit(2))))
    return rows.withColumn("individual", F.concat(F.lit("I"), who.cast("string"))).withColumn("sample", F.concat(F.lit("S"), who.cast("string"))).withColumn("relationship", pick("PROBAND", "MOTHER", "FATHER", "SIBLING")).withColumn("affected", pick("AFFECTED", "UNAFFECTED", "UNAFFECTED", "AFFECTED")).withColumn("ad", F.array("dp", "gq"))


def _evidence(v: Views) -> DataFrame:
    return family.evidence(_calls(v), ["record", "alt_index"])


@query
def pedigree_relationships(v):
    c = v.table("customer")
    parent = lambda k: F.when(F.col("c_custkey") % 10 < 4, "0").otherwise((F.floor(F.col("c_custkey") / 10) * 10 + k + F.when(F.col("c_custkey") % 10 == 9, 2).otherwise(0)).cast("string"))
    tree = c.select(F.floor(F.col("c_custkey") / 10).alias("family"), F.col("c_custkey").cast("string").alias("person"), parent(0).alias("mother"), parent(1).alias("father"), (F.col("c_custkey") % 10 == 5).alias("is_proband"))
    return family.relationships(tree, "is_proband", ("family",)).select("person", "relationship")


@query
def classify_inheritance(v):
    own = _calls(v).withColumn("c", family.carries(F.col("gt"), F.col("alt_index"))).withColumn("r", family.confident_reference(F.col("gt"), F.col("dp"), F.col("gq")))
    of = lambda member, x: F.max(F.when(F.col("member") == member, F.col(x)))
    return own.groupBy("record", "alt_index").agg(family.inheritance(of(2, "c"), of(3, "c"), of(2, "r"), of(3, "r")).alias("inheritance"))


@query
def family_evidence(v):
    return _evidence(v).select("record", "alt_index", *[f"{r}_{x}" for r in ("proband", "mother", "father") for x in ("gt", "dp", "gq")], "inheritance")


@query
def family_carriers(v):
    return _evidence(v).select("record", "alt_index", "affected_carriers", "unaffected_carriers", "shared_siblings")


@query
def family_quality_flags(v):
    return _evidence(v).select("record", "alt_index", "quality_flags")


@query
def format_gt(v):
    return v.family.select("record", "member", text.format_gt(F.col("gt"), F.col("phased")).alias("gt_text"))


# ---- export


@query
def augment_status(v):
    rows = augment.merge(v.ordered_occurrences, v.results, check=False)
    return rows.select("record_ordinal", "alt_index", augment.status(F.col("status"), F.col("result_variant_id")).alias("status"))


@query
def augment_merge(v):
    return augment.merge(v.ordered_occurrences, v.results, check=False).select("record_ordinal", "alt_index", "alt", "error_code", "result_variant_id", "score", "gene")


@query
def augment_misalignment(v):
    return augment.misalignment(v.ordered_occurrences, v.results)


@query
def augment_info_arrays(v):
    rows = augment.merge(v.ordered_occurrences, v.results, check=False, by_record=True)
    rows = rows.select("record_ordinal", "alt_index", augment.status(F.col("status"), F.col("result_variant_id")).alias("statuses"), F.col("error_code").alias("errors"), F.col("gene").alias("genes"))
    return augment.per_record(rows, ["statuses", "errors", "genes"])


@query
def model_score_entries(v):
    number = lambda x: F.coalesce(F.round(x * 1000).cast("long").cast("string"), F.lit("."))
    rows = []
    for k, m in enumerate(MODELS, 1):
        jsd = F.lit(None).cast("double")
        lfc = F.when(F.col("user_id") % 9 != k, F.col(f"logfc_{m}"))
        rest = [F.when(F.col("user_id") % 9 != k, F.col(c)) for c in (f"active_allele_quantile_{m}", f"in_peak_{m}", f"prioritized_{m}")]
        rows.append(text.model_score_entry(F.lit(1), F.lit(f"M{k:04d}"), lfc, jsd, *rest, number=number))
    return v.prioritized.select("user_id", F.array_join(F.array(*rows), ",").alias("entries"))


@query
def json_first_gene(v):
    k = F.get_json_object("props", "$.k")
    listed_ = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('[{"gene_name":"G'), k, F.lit('"},{"gene_name":"X"}]'))).when(F.col("event_id") % 4 == 1, F.concat(F.lit('[{"gene_name":"","symbol":"S'), k, F.lit('"}]'))).when(F.col("event_id") % 4 == 2, F.concat(F.lit('["N'), k, F.lit('"]'))).otherwise(F.concat(F.lit("plain "), k))
    return v.table("events").select("event_id", text.first_gene(listed_).alias("first"))


@query
def motif_name(v):
    part = F.concat(F.lit("pos_patterns."), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("#"), (F.col("p_partkey") % 9).cast("string"), F.lit("_"), F.col("p_size").cast("string"))
    return v.table("part").select("p_partkey", text.motif_name(part).alias("name"))


@query
def union_missing_cols(v):
    a, b = v.table("region").withColumnRenamed("r_name", "name"), v.table("nation").withColumnRenamed("n_name", "name")
    return a.unionByName(b, allowMissingColumns=True)


@query
def content_sha(v):
    return v.table("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
