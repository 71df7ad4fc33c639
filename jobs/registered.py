"""The jobs as queries: each runs twice into a new folder below ``spark.checkpoint.dir``, which stays; what is there then is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.plans.file_queries import folder
from genoframe.plans.views import Views
from jobs import cohort_ingest, common, model_inputs


def job1_model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folder(Views(spark, sf_dir))
    for _ in range(2):
        model_inputs.run(spark, sf_dir, out, common.settings("model_inputs"))
    return model_inputs.read(spark, out)


def job2_cohort_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences, with the number of rows that the table of alleles has for each."""
    out = folder(Views(spark, sf_dir))
    for _ in range(2):
        cohort_ingest.run(spark, sf_dir, f"{out}/tables", f"{out}/checkpoint", common.settings("cohort_ingest"))
    named = cohort_ingest.read(spark, f"{out}/tables", "canonical").groupBy("chrom", "canonical_id").agg(F.count(F.lit(1)).alias("listed"))
    rows = cohort_ingest.read(spark, f"{out}/tables", "occurrences").drop("batch").join(named, ["chrom", "canonical_id"], "left")
    return rows.withColumn("listed", F.coalesce("listed", F.lit(0)).cast("long"))


QUERIES = {"job1_model_inputs": job1_model_inputs, "job2_cohort_ingest": job2_cohort_ingest}

_BASES = "regexp_replace(translate(lower({}), 'bdefhijklmnopqrsuvwxyz .acgt', 'ACGTACGTACGTACGTACGTACGTACGT'), '[^ACGT]', 'N', 'g')"
_JOB1_SQL = f"""
WITH d AS (SELECT doc_id AS id, CASE WHEN doc_id % 19 = 0 THEN -1 - doc_id ELSE doc_id END AS contig, doc_id * 7919 % greatest(length(text), 1) + 1 AS pos, text,
  CASE WHEN doc_id % 26 = 22 THEN 'chrX' WHEN doc_id % 26 = 23 THEN 'chrM' ELSE 'chr' || (doc_id % 26 + 1) END AS chrom,
  CASE doc_id % 7 WHEN 0 THEN 'n' WHEN 1 THEN 'GATTACA' WHEN 2 THEN '' ELSE 'T' END AS alt
  FROM documents WHERE doc_id % 17 <> 0 OR doc_id % 2 = 0),
v AS (SELECT *, CASE WHEN id % 11 = 0 THEN 'GATTACA' ELSE {_BASES.format("substring(text, pos, 1 + id % 3)")} END AS ref, CASE WHEN contig >= 0 THEN {_BASES.format("text")} END AS seq FROM d),
w AS (SELECT *, substring(seq, greatest(pos - 20, 1), least(pos - 1, 20)) || alt || substring(seq, pos + length(ref), greatest(20 - length(alt), 0)) AS tight,
  substring(seq, greatest(pos - 20, 1), least(pos - 1, 20)) || alt || substring(seq, pos + length(ref), 40) AS wide FROM v),
c AS (SELECT *, CASE WHEN seq IS NULL OR NOT regexp_matches(chrom, '^chr([1-9]|1[0-9]|2[0-2]|X|Y)$') THEN 'INVALID_CHROMOSOME' WHEN regexp_matches(ref, '[^ACGT]') THEN 'INVALID_REFERENCE'
  WHEN regexp_matches(alt, '[^ACGT]') THEN 'INVALID_ALTERNATE' WHEN ref IS NULL OR pos IS NULL THEN 'GENOME_ACCESS_ERROR' WHEN pos <= 20 OR substring(seq, pos, length(ref)) <> ref THEN 'REF_MISMATCH'
  WHEN length(tight) <> 40 THEN 'ALT_LENGTH_MISMATCH' WHEN ref = '' OR alt = '' THEN 'EMPTY_ALLELE' END AS error_code FROM w)
SELECT id, CAST(contig AS VARCHAR) AS contig, pos, ref, alt, error_code, CASE WHEN error_code IS NULL THEN rpad(substring(seq, pos - 20, 40), 40, 'N') END AS ref_seq, CASE WHEN error_code IS NULL THEN rpad(left(wide, 40), 40, 'N') END AS alt_seq,
  CASE WHEN error_code IS NULL THEN 'PENDING' WHEN error_code = 'REF_MISMATCH' THEN 'REF_MISMATCH' ELSE 'FAILED' END AS status, chrom FROM c
"""
_JOB2_SQL = """
WITH v AS (SELECT CASE WHEN l_suppkey % 25 = 23 THEN 'chrX' WHEN l_suppkey % 25 = 24 THEN 'chrM' ELSE 'chr' || (l_suppkey % 25 + 1) END AS chrom, (l_partkey * 37 + l_orderkey * 11) % 100000 + 1 AS pos,
  CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'C' ELSE 'G' END || CASE WHEN l_linestatus = 'F' THEN 'TA' ELSE '' END AS ref, CASE WHEN l_partkey % 4 <> 0 THEN 'rs' || l_partkey END AS variant_id,
  CASE l_linenumber WHEN 1 THEN ['T'] WHEN 2 THEN ['A', 'C'] WHEN 3 THEN ['GTT'] WHEN 4 THEN ['*'] WHEN 5 THEN ['<DEL>', 'G'] WHEN 6 THEN ['G]chr1:5]'] ELSE ['.'] END AS alts FROM lineitem),
o AS (SELECT * EXCLUDE (alts), unnest(alts) AS alt, CAST(generate_subscripts(alts, 1) AS INTEGER) AS alt_index FROM v),
c AS (SELECT *, CASE WHEN alt = '*' THEN 'SPANNING_DELETION' WHEN alt = '<DEL>' THEN 'SYMBOLIC_ALT' WHEN contains(alt, ']') THEN 'BREAKEND' WHEN alt = ref THEN 'REF_EQUALS_ALT' WHEN alt = '.' THEN 'MISSING_ALT' END AS error_code FROM o)
SELECT chrom, pos, ref, alt, alt_index, variant_id, error_code, CASE WHEN error_code IS NULL THEN 'PENDING' ELSE 'UNSUPPORTED' END AS status,
  CASE WHEN error_code IS NULL THEN chrom || ':' || pos || ':' || ref || ':' || alt END AS canonical_id, CAST(CASE WHEN error_code IS NULL THEN 1 ELSE 0 END AS BIGINT) AS listed FROM c
"""
ORACLES = {"job1_model_inputs": _JOB1_SQL, "job2_cohort_ingest": _JOB2_SQL}
