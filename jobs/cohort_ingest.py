"""A growing set of variant records: every run takes the files that have come since the last one.

Reads the source ``records(chrom, pos, ref, alt_raw, variant_id)`` of the settings as a file stream that ends when it has caught up.
Writes ``OUT/occurrences`` (a row for each record and alternate allele, with its code if it is not supported), ``OUT/canonical`` (the
distinct supported alleles, each under the batch that first had it) and ``OUT/counts``, Parquet partitioned by ``batch`` and ``chrom``.
The checkpoint names the files that are done and numbers the batches. A batch that is repeated replaces its own partitions, and
the first one of a new checkpoint replaces all.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.functions import alleles
from genoframe.operators import ingest
from jobs import common

log = logging.getLogger("jobs.cohort_ingest")
SCHEMAS = {
    "occurrences": "pos bigint, ref string, alt string, alt_index int, variant_id string, canonical_id string, error_code string, status string, batch bigint, chrom string",
    "canonical": "canonical_id string, pos bigint, ref string, alt string, batch bigint, chrom string",
    "counts": "error_code string, rows bigint, batch bigint, chrom string",
}


def read(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{out}/{name}")


def _write(rows: DataFrame, out: str, name: str, batch: int) -> None:
    mode = "dynamic" if batch else "static"  # the first batch leaves nothing of an older checkpoint
    rows.withColumn("batch", F.lit(batch).cast("long")).hint("rebalance", "chrom").write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd").partitionBy("batch", "chrom").parquet(f"{out}/{name}")


def take(records: DataFrame, out: str, batch: int) -> None:
    """Writes what a batch of records adds."""
    spark = records.sparkSession
    rows = ingest.classify(ingest.split_alts(records.withColumn("chrom", alleles.with_chr(F.col("chrom")))))
    named = ingest.with_canonical_id(rows).withColumn("canonical_id", F.when(F.col("error_code").isNull(), F.col("canonical_id")))
    _write(named.select("pos", "ref", "alt", "alt_index", "variant_id", "canonical_id", "error_code", "status", "chrom"), out, "occurrences", batch)
    # what follows reads the batch as written, not its files again
    own = read(spark, out, "occurrences").where(F.col("batch") == batch)
    new = own.where("error_code IS NULL").select("canonical_id", "pos", "ref", "alt", "chrom").distinct()
    if batch:
        new = new.join(read(spark, out, "canonical").where(F.col("batch") < batch).select("chrom", "canonical_id"), ["chrom", "canonical_id"], "left_anti")
    _write(new.select("canonical_id", "pos", "ref", "alt", "chrom"), out, "canonical", batch)
    _write(own.groupBy("chrom", "error_code").agg(F.count(F.lit(1)).alias("rows")).select("error_code", "rows", "chrom"), out, "counts", batch)
    log.info("batch %d: wrote %d occurrences, %d new alleles", batch, own.count(), read(spark, out, "canonical").where(F.col("batch") == batch).count())


def run(spark: SparkSession, tables: str, out: str, checkpoint: str, config: dict) -> dict:
    """Takes what is new and ends; returns what it read and what there is in all."""
    source = config["records"]
    where, kind = common.place(tables, source).rstrip("/"), source.get("format", "parquet")
    schema = source.get("schema") or spark.read.format(kind).load(where).schema
    # as a pattern that only the path itself matches, a single file may be a source too
    stream = spark.readStream.format(kind).schema(schema).options(**source.get("options", {})).option("maxFilesPerTrigger", config.get("files_per_batch", 1000)).load(f"{where[:-1]}[{where[-1]}]")
    query = common.selected(stream, source).writeStream.foreachBatch(lambda rows, batch: take(rows, out, batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    taken = [p for p in query.recentProgress if p["numInputRows"]]
    total = read(spark, out, "counts").agg(F.sum("rows").alias("n"), F.sum(F.when(F.col("error_code").isNull(), F.col("rows"))).alias("supported")).first()
    told = {"batches": len(taken), "occurrences": total.n or 0, "supported": total.supported or 0, "alleles": read(spark, out, "canonical").count()}
    log.info("read %s: %d new batches; wrote %s, in all: %s", where, len(taken), out, told)
    return told


if __name__ == "__main__":
    common.main("cohort_ingest", "take new files of variant records into a cohort's tables", run, "out", "checkpoint")
