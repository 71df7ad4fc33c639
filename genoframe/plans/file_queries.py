"""Registered queries of the file formats: each writes a view of the driver's tables to files and reads it with the library.

The SQL says what must come back, from the tables alone.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe import schemas
from genoframe.operators import augment, contigs, family, ingest, intervals, regions
from genoframe.plans import jobs
from genoframe.plans.oracles import _CODE, _ORDER, _SEQ, ORACLES, _with
from genoframe.plans.queries import CONTIGS, QUERIES, SPAN
from genoframe.plans.views import ORDER, SEQUENCE, V_SQL, Views
from genoframe.sources import bucketed, readers, shards, sinks
from genoframe.streaming import batches

FILE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
FILE_ORACLES: dict[str, str] = {}
SETTING = "spark.checkpoint.dir"
_ID, _SQL_ID = "CASE WHEN l_partkey % 4 <> 0 THEN concat('rs', l_partkey) END", "CASE WHEN l_partkey % 4 <> 0 THEN 'rs' || l_partkey END"


def query(sql: str):
    def register(f: Callable[[Views], DataFrame]):
        FILE_QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        FILE_ORACLES[f.__name__] = sql
        return f

    return register


def folder(v: Views) -> str:
    """A new folder that all executors share: below the one of ``spark.checkpoint.dir``; a local one only where all runs in one process."""
    root = v.spark.conf.get(SETTING, None)
    if not root:
        if not (v.spark.sparkContext.master + "[").startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="genoframe-")
        v.spark.conf.set(SETTING, root)
    return f"{root.rstrip('/')}/files-{uuid.uuid4().hex[:12]}"


def write_lines(head: list[str], rows: DataFrame, order: list[str], path: str) -> None:
    """Text of ``rows(value, <order>)`` below ``head`` in a folder of parts, in order of part and line."""
    first = rows.sparkSession.createDataFrame([(k, x) for k, x in enumerate(head)], "_head int, value string")
    both = first.unionByName(rows.select("value", *order), allowMissingColumns=True)
    # lines of the head have a number; rows have none and come after them
    keys = [F.col("_head").asc_nulls_last(), *order]
    both.repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.text(path)


def _alleles(v: Views) -> DataFrame:
    return v.canonical_rows.select(F.col("chrom").alias("chr"), "pos", "ref", "alt", F.expr(_ID).alias("variant_id"))


_ALLELES_SQL = _with("k", f"SELECT chrom AS chr, pos, ref, alt, {_SQL_ID} AS variant_id FROM k")


# ---- variant tables and VCF


@query(_ALLELES_SQL)
def tsv_scan(v):
    path = folder(v)
    sinks.write_tsv(_alleles(v), path)
    return readers.read_variants(v.spark, path, "tsv")


def _vcf(v: Views) -> str:
    """A sorted VCF of all variants but those that only a genomic VCF has."""
    path = folder(v)
    head = ["##fileformat=VCFv4.2", *[f"##contig=<ID={c}>" for c in CONTIGS], "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"])]
    rows = v.variants.where("NOT (alt_raw = '.' AND length(ref) > 1)").withColumn("rid", F.col("l_suppkey") % 25)
    quality = F.when(F.col("l_partkey") % 5 != 0, (F.col("l_partkey") % 90).cast("string")).otherwise(".")
    state = F.when(F.col("l_partkey") % 3 == 0, "q10").otherwise("PASS")
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.expr(f"coalesce({_ID}, '.')"), "ref", "alt_raw", quality, state, F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit("PK="), F.col("l_partkey").cast("string"))).otherwise("."))
    write_lines(head, rows.select("rid", "pos", *ORDER, line.alias("value")), ["rid", "pos", *ORDER], path)
    return path


_RECORDS_SQL = f"WITH v AS ({V_SQL}), f AS (SELECT *, row_number() OVER (ORDER BY l_suppkey % 25, pos, {_ORDER}) - 1 AS record_ordinal FROM v WHERE NOT (alt_raw = '.' AND length(ref) > 1))"


@query(_ALLELES_SQL)
def vcf_scan(v):
    return readers.read_variants(v.spark, _vcf(v), "vcf")


@query(
    f"{_RECORDS_SQL} SELECT record_ordinal, chrom, pos, {_SQL_ID} AS variant_id, ref, alt_raw, CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_partkey % 90 AS VARCHAR) ELSE '.' END AS qual, "
    "CASE WHEN l_partkey % 3 = 0 THEN 'q10' ELSE 'PASS' END AS filter, CASE WHEN l_partkey % 2 = 0 THEN 'PK=' || l_partkey ELSE '.' END AS info FROM f"
)
def vcf_records(v):
    return readers.read_vcf_records(v.spark, _vcf(v))[1].drop("format", "samples")


_OCCURRENCE_SQL = (
    f"SELECT record_ordinal, CAST(alt_index AS INTEGER) AS alt_index, 'GRCh38' AS genome, chrom AS chr, pos, ref, alt, {_SQL_ID} AS variant_id, chrom || ':' || pos || ':' || ref || ':' || alt AS canonical_variant_id, "
    f"CASE WHEN ({_CODE}) IS NULL THEN 'PENDING' ELSE 'UNSUPPORTED' END AS status, {_CODE} AS error_code"
)


@query(f"{_RECORDS_SQL}, x AS (SELECT *, unnest(string_split(alt_raw, ',')) AS alt, generate_subscripts(string_split(alt_raw, ','), 1) AS alt_index FROM f WHERE alt_raw <> '.') {_OCCURRENCE_SQL} FROM x")
def vcf_occurrences(v):
    return readers.vcf_occurrences(v.spark, _vcf(v), "GRCh38")


@query(_with("o", f"{_OCCURRENCE_SQL} FROM (SELECT * EXCLUDE (alt_index, record_ordinal, error_code), 1 AS alt_index, row_number() OVER (ORDER BY {_ORDER}, alt_index) - 1 AS record_ordinal FROM o)"))
def tsv_occurrences(v):
    path = folder(v)
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), "ref", "alt", F.expr(f"coalesce({_ID}, '')"))
    write_lines([], v.occurrences.select(*ORDER, "alt_index", line.alias("value")), [*ORDER, "alt_index"], path)
    return readers.tsv_occurrences(v.spark, path, "GRCh38")


@query(f"WITH v AS ({V_SQL}) SELECT {_ORDER} FROM v WHERE l_linenumber = 3 OR (alt_raw = '.' AND length(ref) > 1)")
def gvcf_records(v):
    marked = F.when(F.col("l_linenumber") == 3, F.concat("alt_raw", F.lit(",<NON_REF>"))).otherwise(F.col("alt_raw"))
    rows = v.variants.withColumn("alt_raw", marked).withColumn("stop", F.col("pos") + F.length("ref") - 1)
    return ingest.genomic_vcf_records(rows).select(*ORDER)


@query(
    f"{_RECORDS_SQL} SELECT record_ordinal, chrom, pos, {_SQL_ID} AS variant_id, ref, alt_raw, coalesce(concat_ws(';', CASE WHEN l_partkey % 2 = 0 THEN 'PK=' || l_partkey END, "
    "CASE WHEN pos % 3 <> 0 THEN 'GF_STATUS=S' || pos % 3 END, CASE WHEN pos % 4 = 0 THEN 'GF_REGION=' || ref END), '') AS info FROM f"
)
def augmented_vcf(v):
    """Annotated twice, by the file that the first run wrote: the second run replaces its own fields."""
    path, out = _vcf(v), folder(v)
    for k, (source, target) in enumerate(((path, f"{out}-1"), (f"{out}-1", f"{out}-2"))):
        header, records = readers.read_vcf_records(v.spark, source)
        status = F.when(F.col("pos") % 3 != 0, F.concat(F.lit("S" if k else "old"), (F.col("pos") % 3).cast("string")))
        fields = records.select("record_ordinal", status.alias("STATUS"), F.when(F.col("pos") % 4 == 0, F.col("ref")).alias("REGION"))
        sinks.write_augmented_vcf(header, records, fields, target, "GF")
    rows = readers.read_vcf_records(v.spark, f"{out}-2")[1]
    return rows.select("record_ordinal", "chrom", "pos", "variant_id", "ref", "alt_raw", F.when(F.col("info") == ".", "").otherwise(F.col("info")).alias("info"))


# ---- reference sequence, gene models, tables of annotations


@query(f"SELECT contig, chunk, substring(seq, chunk * {contigs.SIZE} + 1, {contigs.SIZE + contigs.OVERLAP}) AS seq FROM (SELECT *, unnest(range(0, (length(seq) - 1) // {contigs.SIZE} + 1)) AS chunk FROM (SELECT 'd' || doc_id AS contig, regexp_replace({_SEQ}, '[^ACGTN]', 'N', 'g') AS seq FROM documents WHERE length(text) > 0))")
def fasta_chunks(v):
    path = folder(v)
    # documents are put in order before their letters and lines are made; a row is a contig's lines
    docs = v.table("documents").where("length(text) > 0").select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    lines = F.regexp_replace(F.regexp_replace(F.expr(SEQUENCE), "[^ACGTN]", "N"), "(.{60})(?=.)", "$1\n")
    docs.select(F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit(" made of prose\n"), lines).alias("value")).write.text(path)
    return readers.read_fasta_chunks(v.spark, path)


@query(
    f"SELECT id, substring(seq, a + 1, 90) AS seq FROM (SELECT doc_id AS id, (doc_id * 131) % 700 - 20 AS a, {_SEQ} AS seq FROM documents) WHERE a >= 0 AND a + 90 <= length(seq)"
)
def peak_sequences(v):
    start = (F.col("contig") * 131) % 700 - 20
    peaks = v.contigs.select(F.col("contig").alias("id"), start.alias("window_start"), (start + 90).alias("window_end"))
    return contigs.window_sequences(peaks, v.contigs, 90, "id").select("id", "seq")


@query(
    "SELECT CASE k WHEN 24 THEN 'chrX' WHEN 25 THEN 'chrY' WHEN 26 THEN 'chrM' ELSE 'chr' || k END AS chrom, 'gene' AS feature, c_custkey * 7 AS start, c_custkey * 7 + 100 AS \"end\", CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'ID=gene:G' || c_custkey || ';Name=' || c_name AS attributes "
    "FROM (SELECT *, c_custkey % 27 AS k FROM customer) WHERE k NOT IN (0, 23)"
)
def gff_scan(v):
    path = folder(v)
    seqid = "CASE c_custkey % 27 WHEN 0 THEN 'KI270728.1' WHEN 23 THEN 'scaffold_23' WHEN 24 THEN 'X' WHEN 25 THEN 'Y' WHEN 26 THEN 'MT' ELSE CAST(c_custkey % 27 AS string) END"
    line = F.expr(f"concat_ws('\t', {seqid}, 'made', 'gene', CAST(c_custkey * 7 AS string), CAST(c_custkey * 7 + 100 AS string), '.', CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END, '.', concat('ID=gene:G', c_custkey, ';Name=', c_name))")
    write_lines(["##gff-version 3", "#!genome-build made"], v.table("customer").select("c_custkey", line.alias("value")), ["c_custkey"], path)
    return readers.read_gff(v.spark, path).select("chrom", "feature", "start", "end", "strand", "attributes")


@query("SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, p_partkey * 10 AS start, p_partkey * 10 + p_size AS \"end\", 'EH' || p_partkey AS accession, 'D' || p_size AS registry, p_type AS grp FROM part")
def ccre_scan(v):
    path = folder(v)
    rows = v.table("part").selectExpr("concat('chr', p_partkey % 22 + 1) AS chrom", "p_partkey * 10 AS start", "p_partkey * 10 + p_size AS end", "concat('EH', p_partkey) AS accession", "concat('D', p_size) AS registry", "p_type AS grp")
    sinks.write_tsv(rows, path)
    return readers.read_ccre(v.spark, path)


_MISSENSE = ["concat('chr', p_partkey % 22 + 1) AS CHROM", "CAST(p_partkey * 10 AS int) AS POS", "'A' AS REF", "'T' AS ALT", "'hg38' AS genome", "concat('P', p_size) AS uniprot_id", "concat('ENST', p_partkey) AS transcript_id", "'M1V' AS protein_variant", "(p_partkey % 1000) / 1000.0D AS am_pathogenicity", "p_type AS am_class"]
_MISSENSE_SQL = "SELECT 'chr' || (p_partkey % 22 + 1) AS CHROM, CAST(p_partkey * 10 AS INTEGER) AS POS, 'A' AS REF, 'T' AS ALT, 'hg38' AS genome, 'P' || p_size AS uniprot_id, 'ENST' || p_partkey AS transcript_id, 'M1V' AS protein_variant, CAST((p_partkey % 1000) / 1000.0 AS DOUBLE) AS am_pathogenicity, p_type AS am_class FROM part"


@query(_MISSENSE_SQL)
def missense_scan(v):
    path = folder(v)
    rows = v.table("part").selectExpr(*_MISSENSE)
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in rows.columns])
    head = ["# Copyright", "# License", "# Notes", "#" + "\t".join(rows.columns)]
    write_lines(head, rows.select("CHROM", "POS", line.alias("value")), ["CHROM", "POS"], path)
    return readers.read_missense(v.spark, path)


@query(f"SELECT * FROM ({_MISSENSE_SQL}) WHERE CHROM IN ('chr3', 'chr21')")
def hive_scan(v):
    path = folder(v)
    sinks.write_hive(v.table("part").selectExpr(*_MISSENSE), path)
    return v.spark.read.parquet(path).where("CHROM IN ('chr3', 'chr21')")


@query("SELECT 'C' || c_custkey AS variant_id, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS counts_log2fc, CAST(c_custkey / 8.0 AS DOUBLE) AS profile_l1 FROM customer")
def fold_scores_scan(v):
    path = folder(v)
    rows = v.table("customer").selectExpr("concat('C', c_custkey) AS variant_id", "CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS counts_log2fc", "c_custkey / 8.0D AS profile_l1")
    sinks.write_tsv(rows, path, header=True)
    return readers.read_fold_scores(v.spark, path)


# ---- sinks and jobs


@query("SELECT CAST(o_orderkey % 5 AS INTEGER) AS bucket, o_orderkey AS record_ordinal, 1 AS alt_index, o_totalprice AS score, CASE WHEN o_orderkey % 5 < 2 THEN o_orderpriority END AS extra FROM orders")
def buckets_scan(v):
    path = folder(v)
    rows = v.table("orders").selectExpr("o_orderkey AS record_ordinal", "1 AS alt_index", "o_totalprice AS score", "o_orderpriority AS extra", "CAST(o_orderkey % 5 AS int) AS bucket")
    rows.where("bucket < 2").write.partitionBy("bucket").parquet(path)
    rows.where("bucket >= 2").drop("extra").write.mode("append").partitionBy("bucket").parquet(path)
    return readers.read_buckets(v.spark, path)


@query(ORACLES["augment_merge"])
def bucketed_merge(v):
    """Alleles and results are stored in the same buckets, and merged where they lie. Results are made of the stored alleles, so records are
    numbered once, and lie in the buckets of the results already."""
    path = folder(v)
    v.ordered_occurrences = bucketed.write(v.ordered_occurrences.select(*augment.KEY, "alt", "error_code", "l_extendedprice", "l_partkey"), f"{path}/alleles", augment.KEY)
    results = bucketed.write(v.results.select(*augment.KEY, "result_variant_id", "score", "gene"), f"{path}/results", augment.KEY)
    return augment.merge(v.ordered_occurrences.select(*augment.KEY, "alt", "error_code"), results, check=False)


@query(ORACLES["region_routing"])
def category_files(v):
    path = folder(v)
    routed = QUERIES["region_routing"](v.spark, v.sf_dir)
    counts = sinks.write_categories(routed, path, tuple(regions.CATEGORIES))
    back = v.spark.read.schema("chrom string, pos long, ref string, category string").option("sep", "\t").csv(path)
    if sum(counts.values()) != back.count():
        raise ValueError("counts of the categories are not those of the files")
    return back.select(*SPAN, "category")


@query(_with("k", f"SELECT chrom AS chr, pos, ref, alt, {_SQL_ID} AS variant_id, 5 AS fields FROM k"))
def json_lines(v):
    """Read as text too: every line names all five fields."""
    path = folder(v)
    sinks.write_jsonl(_alleles(v), path)
    lines = v.spark.read.text(path)
    row = F.from_json("value", schemas.VARIANT)
    return lines.select(row.alias("r"), F.size(F.json_object_keys("value")).alias("fields")).select("r.*", "fields")


@query(_with("o", f"SELECT {_ORDER}, CAST(alt_index AS INTEGER) AS alt_index, alt, error_code FROM o WHERE error_code IS NOT NULL"))
def invalid_table(v):
    """A gzipped table with a header line in every part."""
    path = folder(v)
    rows = v.occurrences.where("error_code IS NOT NULL").select(*ORDER, "alt_index", "alt", "error_code")
    sinks.write_tsv(rows, path, header=True, compression="gzip")
    return v.spark.read.schema(rows.schema).option("sep", "\t").option("header", True).csv(path)


@query("SELECT o_orderkey, o_totalprice, true AS first_run, false AS second_run, true AS third_run, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS manifest_rows FROM orders WHERE o_orderkey % 2 = 0")
def write_once_shards(v):
    """A run with an old fingerprint writes nothing; one with a new fingerprint replaces all and its manifest."""
    path = folder(v)
    rows = v.table("orders").select("o_orderkey", "o_totalprice")
    ran = [sinks.write_once(rows, path, "a"), sinks.write_once(rows.limit(0), path, "a"), sinks.write_once(rows.where("o_orderkey % 2 = 0"), path, "b")]
    told = sinks.read_manifest(v.spark, f"{path}.manifest.json")
    flags = [F.lit(x).alias(f"{n}_run") for x, n in zip(ran, ("first", "second", "third"), strict=True)]
    return v.spark.read.parquet(path).select("o_orderkey", "o_totalprice", *flags, F.lit(told["rows"]).cast("long").alias("manifest_rows"))


@query(ORACLES["region_annotation"])
def region_index(v):
    """Labels by a stored index of the regions, opened again from its files."""
    path = folder(v)
    intervals.write_index(regions.condensed(v.regions), path)
    table, levels = intervals.read_index(v.spark, path)
    out = regions.annotate(v.variants, table, levels)
    return out.select("chrom", "pos", "ref", F.array_join("labels", ",").alias("labels"), F.array_join("gene_ids", ",").alias("gene_ids"))


@query("SELECT CAST(o_orderkey % 3 AS INTEGER) AS bucket, o_orderkey, o_totalprice, '0,1,2,3,4;;2,3;0,1,2' AS written FROM orders")
def bucket_shards(v):
    """Five buckets; nothing to do; a lost and a damaged one; then three buckets, of which no old one is left."""
    path = folder(v)
    rows = v.table("orders").select("o_orderkey", "o_totalprice")

    def run(buckets: int) -> str:
        some = lambda numbers: rows.withColumn("bucket", F.expr(f"CAST(o_orderkey % {buckets} AS int)")).where(F.col("bucket").isin(numbers))
        return ",".join(map(str, shards.complete(some, path, "bucket", range(buckets), f"plan of {buckets}", 2)))

    ran = [run(5), run(5)]
    sinks.delete(v.spark, f"{path}/bucket=2")
    rows.limit(1).write.mode("append").parquet(f"{path}/bucket=3")
    ran += [run(5), run(3)]
    return v.spark.read.parquet(path).select("bucket", "o_orderkey", "o_totalprice", F.lit(";".join(ran)).alias("written"))


@query(_with("k", "SELECT DISTINCT canonical_id, CAST(2 - pos % 2 AS INTEGER) AS run FROM k"))
def append_scores(v):
    """Odd positions are scored by the first run, the rest by the second; the third finds nothing to do."""
    path = folder(v)
    rows = ingest.canonical(v.occurrences)
    for k, some in enumerate((rows.where("pos % 2 = 1"), rows, rows), 1):
        jobs.append_scores(some, path, lambda x, k=k: x.select("canonical_id", F.lit(k).alias("run")))
    return v.spark.read.parquet(path)


_DROPPED_SQL = (
    "SELECT id, chrom, pos, ref, alt, error_code, CASE WHEN error_code IS NULL THEN 'PENDING' WHEN error_code = 'REF_MISMATCH' THEN 'REF_MISMATCH' WHEN error_code = 'REF_EQUALS_ALT' THEN 'UNSUPPORTED' ELSE 'FAILED' END AS status FROM ("
    "SELECT *, CASE WHEN alt = ref THEN 'REF_EQUALS_ALT' WHEN p = 23 THEN 'INVALID_CHROMOSOME' WHEN pos <= 20 OR pos > 400 OR substring('ACGT', CAST((pos - 1) % 4 + 1 AS INTEGER), 1) <> ref THEN 'REF_MISMATCH' WHEN pos + 19 > 400 THEN 'ALT_LENGTH_MISMATCH' END AS error_code FROM ("
    "SELECT 'v' || c_custkey AS id, c_custkey % 23 + 1 AS p, 'chr' || (c_custkey % 23 + 1) AS chrom, c_custkey * 7 % 420 + 1 AS pos, substring('ACGTA', CAST(c_custkey * 7 % 4 + 1 + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INTEGER), 1) AS ref, substring('GTCA', CAST(c_custkey % 4 + 1 AS INTEGER), 1) AS alt FROM customer))"
)


@query(_DROPPED_SQL)
def drop_folder(v):
    """Two streaming runs over one folder: the second takes the files that came after the first."""
    path = folder(v)
    rows = _dropped(v)
    for half in (0, 1):
        sinks.write_tsv(rows.where(F.col("c_custkey") % 2 == half).drop("c_custkey"), f"{path}/in", mode="append")
        batches.ingest_folder(v.spark, f"{path}/in", _repeats(v), f"{path}/out", f"{path}/checkpoint", width=40)
    return v.spark.read.parquet(f"{path}/out").select(F.col("variant_id").alias("id"), "chrom", "pos", "ref", "alt", "error_code", "status")


def _repeats(v: Views) -> DataFrame:
    return v.spark.range(1, 24).selectExpr("concat('chr', id) AS contig", "repeat('ACGT', 100) AS seq")


def _dropped(v: Views) -> DataFrame:
    ref = "substring('ACGTA', CAST(c_custkey * 7 % 4 + 1 + CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS int), 1)"
    return v.table("customer").selectExpr("concat('chr', c_custkey % 23 + 1) AS chr", "c_custkey * 7 % 420 + 1 AS pos", f"{ref} AS ref", "substring('GTCA', CAST(c_custkey % 4 + 1 AS int), 1) AS alt", "concat('v', c_custkey) AS variant_id", "c_custkey")


_KEY = "CAST(substr(id, 2) AS BIGINT)"


@query(
    f"SELECT 'V' || {_KEY} % 40 AS vcf, row_number() OVER (PARTITION BY {_KEY} % 40 ORDER BY CAST(substr(chrom, 4) AS INTEGER), pos, {_KEY}) - 1 AS record_ordinal, 1 AS alt_index, *, CAST(NULL AS VARCHAR) AS refusal FROM ({_DROPPED_SQL}) WHERE {_KEY} % 40 NOT IN (7, 12) "
    "UNION ALL SELECT 'V7', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'MALFORMED_VCF' UNION ALL SELECT 'V12', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'UNSORTED_VCF'"
)
def vcf_drop_folder(v):
    """Forty VCFs, the even ones before a first run, the others before a second; one has no line of column names and one is not sorted."""
    path = folder(v)
    rows = _dropped(v).withColumn("vcf", F.col("c_custkey") % 40)
    place = F.regexp_extract("chr", r"(\d+)", 1).cast("int")
    line = F.concat_ws("\t", "chr", F.col("pos").cast("string"), "variant_id", "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."))
    body = rows.select("vcf", F.when(F.col("vcf") == 12, -place).otherwise(place).alias("a"), "pos", "c_custkey", line.alias("value"))
    declared = v.spark.range(40).select(F.col("id").alias("vcf"), F.explode(F.sequence(F.lit(1), F.lit(23))).alias("k")).select("vcf", (F.col("k") - 100).alias("a"), F.concat(F.lit("##contig=<ID=chr"), F.col("k").cast("string"), F.lit(">")).alias("value"))
    named = v.spark.range(40).where("id <> 7").select(F.col("id").alias("vcf"), F.lit(-50).alias("a"), F.lit(_HEAD).alias("value"))
    lines = body.unionByName(declared.unionByName(named), allowMissingColumns=True)
    for half in (0, 1):
        some = lines.where(F.col("vcf") % 2 == half)
        some.repartition("vcf").sortWithinPartitions("vcf", "a", "pos", "c_custkey").select("vcf", "value").write.mode("append").partitionBy("vcf").text(f"{path}/in")
        batches.ingest_vcf_folder(v.spark, f"{path}/in", _repeats(v), f"{path}/out", f"{path}/checkpoint", width=40)
    name = F.concat(F.lit("V"), F.regexp_extract("file", r"/vcf=(\d+)/", 1)).alias("vcf")
    done = v.spark.read.parquet(f"{path}/out/occurrences").select(name, "record_ordinal", "alt_index", F.col("variant_id").alias("id"), "chrom", "pos", "ref", "alt", "error_code", "status")
    return done.unionByName(v.spark.read.parquet(f"{path}/out/refused").select(name, F.col("code").alias("refusal")), allowMissingColumns=True)


# ---- refusals, and the context of a family


def _code(run: Callable) -> str:
    try:
        return str(run())
    except readers.InputError as e:
        return e.code
    except ValueError as e:
        return type(e).__name__


_HEAD = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"
#: Cases and what they must give.
_REFUSALS = (
    ("format A.TSV.GZ", lambda v: readers.resolve_format("A.TSV.GZ"), "tsv"),
    ("format a.vcf.bgz", lambda v: readers.resolve_format("a.vcf.bgz"), "vcf"),
    ("format told", lambda v: readers.resolve_format("a.data", "vcf"), "vcf"),
    ("format a.bcf", lambda v: readers.resolve_format("a.bcf"), "UNSUPPORTED_BCF"),
    ("format a.parquet", lambda v: readers.resolve_format("a.parquet"), "UNKNOWN_FORMAT"),
    ("format wrong", lambda v: readers.resolve_format("a.tsv", "xml"), "UNKNOWN_FORMAT"),
    ("header plain", lambda v: readers.check_header([_HEAD]), "None"),
    ("header of a name", lambda v: readers.check_header([_HEAD], "a.gvcf.gz"), "UNSUPPORTED_GVCF"),
    ("header with blocks", lambda v: readers.check_header(["##GVCFBlock0-1=minGQ=0", _HEAD]), "UNSUPPORTED_GVCF"),
    ("header with an allele", lambda v: readers.check_header(["##ALT=<ID=NON_REF,Description=x>", _HEAD]), "UNSUPPORTED_GVCF"),
    ("header without columns", lambda v: readers.check_header(["##fileformat=VCFv4.2"]), "MALFORMED_VCF"),
    ("unsorted", lambda v: readers.vcf_occurrences(v.spark, _file(v, _HEAD, "chr1\t9\t.\tA\tC\t.\t.\t.", "chr1\t8\t.\tA\tC\t.\t.\t."), "g"), "UNSORTED_VCF"),
    ("unknown sample", lambda v: readers.vcf_occurrences(v.spark, _file(v, _HEAD, "chr1\t9\t.\tA\tC\t.\t.\t."), "g", "x"), "TARGET_SAMPLE_NOT_FOUND"),
    ("reference block", lambda v: readers.vcf_occurrences(v.spark, _file(v, _HEAD, "chr1\t9\t.\tA\t.\t.\t.\tEND=20"), "g"), "UNSUPPORTED_GVCF"),
    ("short record", lambda v: readers.read_vcf(v.spark, _file(v, _HEAD, "chr1\t9\t.\tA")), "MALFORMED_VCF"),
    ("short row", lambda v: readers.tsv_occurrences(v.spark, _file(v, "chr1\t9\tA"), "g"), "MALFORMED_TSV"),
    ("position", lambda v: readers.tsv_occurrences(v.spark, _file(v, "chr1\tx\tA\tC"), "g"), "MALFORMED_TSV"),
    ("scores", lambda v: readers.read_fold_scores(v.spark, _file(v, "variant_id\tscore")), "MALFORMED_SCORES"),
    ("no bucket", lambda v: readers.read_buckets(v.spark, _nothing(v)), "EMPTY_BUCKET"),
    ("duplicate key", lambda v: ingest.require_unique(v.table("nation"), "n_regionkey"), "DuplicateKeys"),
    ("sample", lambda v: family.require_samples([{"sample": "x"}], ["y"]), "ValueError"),
    ("category", lambda v: regions.checked(["coding", "other"]), "ValueError"),
)


def _file(v: Views, *lines: str) -> str:
    path = folder(v)
    v.spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def _nothing(v: Views) -> str:
    path = folder(v)
    v.table("region").limit(0).write.parquet(path)
    return path


@query("SELECT * FROM (VALUES " + ", ".join(f"('{name}', '{code}')" for name, _, code in _REFUSALS) + ") t(input, result)")
def refused_inputs(v):
    return v.spark.createDataFrame([(name, _code(lambda run=run: run(v))) for name, run, _ in _REFUSALS], "input string, result string")


@query(
    "SELECT 'P' || n_nationkey AS individual, 'S' || n_nationkey AS sample, CASE n_nationkey WHEN 7 THEN 'PROBAND' WHEN 1 THEN 'MOTHER' WHEN 2 THEN 'FATHER' ELSE CASE WHEN n_nationkey % 4 = 3 THEN 'SIBLING' ELSE 'RELATIVE' END END AS relationship, "
    "CASE WHEN n_regionkey = 0 THEN 'AFFECTED' ELSE 'UNAFFECTED' END AS affected FROM nation WHERE n_nationkey % 6 <> 5"
)
def family_context(v):
    """A phenopacket of all nations; those of every sixth have no sample."""
    people = v.table("nation").collect()  # 25 rows
    persons = [{"individualId": f"P{p.n_nationkey}", "maternalId": "P1" if p.n_nationkey % 4 == 3 else "0", "paternalId": "P2" if p.n_nationkey % 4 == 3 else None, "affectedStatus": "AFFECTED" if p.n_regionkey == 0 else "UNAFFECTED"} for p in people]
    samples = {f"P{p.n_nationkey}": f"S{p.n_nationkey}" for p in people if p.n_nationkey % 6 != 5}
    packet = {"id": "F", "proband": {"subject": {"id": "P7"}}, "pedigree": {"persons": persons}, "files": [{"uri": "file:///x/a.vcf", "individualToFileIdentifiers": samples}, {"uri": "b.vcf"}]}
    with tempfile.TemporaryDirectory() as local:  # read by the driver alone
        path = os.path.join(local, "family.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(packet, f)
        members = family.load_context(path, "/data/a.vcf")["members"]
    return v.spark.createDataFrame([(m["individual"], m["sample"], m["relationship"], m["affected"]) for m in members], "individual string, sample string, relationship string, affected string")
