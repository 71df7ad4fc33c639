"""Incremental ingest of a drop folder: each file is taken once, and a restart goes on where the last run ended."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe import schemas
from genoframe.functions import alleles
from genoframe.operators import ingest, validate
from genoframe.sources import readers


def ingest_folder(spark: SparkSession, folder: str, contigs: DataFrame, out: str, checkpoint: str, width: int = 2114, genome: str = "GRCh38") -> None:
    """Validates every table that has come into ``folder`` and appends it to ``out``, then ends.

    The checkpoint names the files that are done. A batch that is repeated after a failure replaces its own partition.
    """
    lines = spark.readStream.schema(schemas.VARIANT).option("sep", "\t").csv(folder)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.lit(genome).alias("genome"), F.col("chr").alias("chrom"), "pos", "ref", "alt", "variant_id")
        done = validate.validate(ingest.classify(rows), contigs, width)
        named = ingest.with_canonical_id(done.withColumn("chrom", alleles.with_chr(F.col("chrom"))))
        named.write.mode("overwrite").parquet(f"{out}/batch={number}")

    lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_vcf_folder(spark: SparkSession, folder: str, contigs: DataFrame, out: str, checkpoint: str, width: int = 2114, genome: str = "GRCh38", files: int = 1000) -> None:
    """Validates the alleles of every VCF that has come into ``folder`` or below it, then ends; at most ``files`` of them a batch.

    ``out/occurrences`` gets ``file``, record and allele numbers within it, canonical id and status; ``out/refused`` the files that cannot
    be taken, with code and reason, which do not stop the others. The checkpoint names the files that are done. A batch that is
    repeated after a failure replaces its own partitions.
    """
    lines = readers.with_split(spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).text(folder))

    def write(batch: DataFrame, number: int) -> None:
        batch.persist(StorageLevel.DISK_ONLY)  # headers, order and records are told from the same lines; lost ones are read again
        try:
            rows, refused = readers.vcf_occurrences_by_file(batch, genome)
            checked = validate.validate(rows.drop("canonical_variant_id").withColumnRenamed("chr", "chrom"), contigs, width)
            refused.write.mode("overwrite").parquet(f"{out}/refused/batch={number}")
            ingest.with_canonical_id(checked).write.mode("overwrite").parquet(f"{out}/occurrences/batch={number}")
        finally:
            batch.unpersist()

    lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
