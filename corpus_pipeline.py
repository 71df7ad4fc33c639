"""From raw documents to training ids: quality, language, near-duplicates, source mixing, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import bpe, langid, minhash, mixing, quality
from genoframe.llm.queries import BYTE_BPE, PIECES, vocabulary
from genoframe.llm.scratch import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to all documents it is given, does not take for junk.

    Null, empty and blank texts go; rows that repeat a text all stay or all go; an empty table stays empty; other columns, null
    ids among them, do not matter.
    """
    return quality.keep(docs, quality.train(docs))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; without letters or any certainty they go.

    The languages are those of the rows' own labels, which only train; a tie between two goes to the first one in order and stays.
    Rows that repeat a text all stay or all go; without any label, and from an empty table, none stays.
    """
    path = vocabulary(PIECES)
    return langid.keep(docs, path, *langid.train(docs, path))


def _row_key() -> Column:
    """A number for each id and text, in the order of ids; rows without an id come last and are known by their text alone."""
    digest = [F.pmod(h, F.lit(10**18)).cast("decimal(38,0)") for h in (F.xxhash64("text"), F.xxhash64(F.lit(1), "text"))]
    scale = F.lit(10**18).cast("decimal(19,0)")
    named = (F.col("doc_id").cast("decimal(19,0)") * scale).cast("decimal(38,0)") + digest[0]
    nameless = F.lit(str(10**37)).cast("decimal(38,0)") + (digest[0].cast("decimal(18,0)") * scale).cast("decimal(38,0)") + digest[1]
    return F.coalesce(named.cast("decimal(38,0)"), nameless.cast("decimal(38,0)"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that of the smallest doc_id, one without an id if none has one.

    Rows that share an id but not a text are told apart; of rows that repeat an id and a text one stays, whichever (they differ in other
    columns at most); rows with neither an id nor a word all stay; an empty table stays empty.
    """
    blank = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(r"[^ \t-\r]"), F.lit(False))
    keyed = docs.where(~blank).withColumn("_row", _row_key())
    scratch = Scratch(spark, "dedup")
    flags = scratch.put(minhash.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text"), scratch), "flags")
    gone = flags.where("NOT kept").select(F.col("doc_id").alias("_row")).distinct()
    # texts are not shuffled where the rows that go are few enough to be broadcast, and gathered by key only if a key is repeated
    gone = F.broadcast(gone) if gone.count() <= minhash.BROADCAST_IDS else gone
    named = keyed.join(gone, "_row", "left_anti")
    if not flags.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").isEmpty():
        named = named.dropDuplicates(["_row"])
    return named.select(*docs.columns).unionByName(docs.where(blank))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the curriculum.

    Ties go to the id; rows that repeat an id are taken on their own; texts without words take no part of the mix's words but may
    come with it; a null source is one source; an empty table stays empty.
    """
    mixed = mixing.mix(docs, carry=tuple(c for c in docs.columns if c not in ("doc_id", "source")))
    return mixing.curriculum(mixed).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens`` of every row; a null text has no tokens."""
    return bpe.encode(docs, vocabulary(BYTE_BPE), bounds=bpe.SMALL).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality_stage), ("language", language_stage), ("dedup", dedup_stage), ("mixing", mixing_stage), ("encoding", encoding_stage)]

#: The classifiers, the sketches and the encoder have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each stage's result is written and read again before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
