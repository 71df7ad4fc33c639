"""Model jobs that go on where they stopped: scores of variants, predictions of folds."""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators import inference, ingest
from genoframe.plans import pipelines
from genoframe.sources import readers, shards, sinks

BUCKETS = 64


def loader(name: str) -> Callable:
    """The function ``load`` of ``module:load``; see ``inference.predict``."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _prepared(variants: DataFrame) -> DataFrame:
    named = variants.withColumn("chrom", F.col("chr")) if "chrom" not in variants.columns else variants
    return ingest.with_canonical_id(named, name="canonical_id")


def _bucketed(variants: DataFrame, buckets: int) -> DataFrame:
    return variants.withColumn("bucket", F.pmod(F.xxhash64("canonical_id"), F.lit(buckets)).cast("int"))


def in_buckets(variants: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, fingerprint: str, buckets: int = BUCKETS, at_once: int | None = None) -> int:
    """Writes ``work`` of the variants, which keeps their ``canonical_id``, to ``out/bucket=N``; buckets that an earlier run with the same
    fingerprint and number of buckets has written stay, see ``shards.complete``. Returns how many were written."""
    rows = _bucketed(_prepared(variants), buckets)
    some = lambda numbers: _bucketed(work(rows.where(F.col("bucket").isin(numbers)).drop("bucket")), buckets)
    return len(shards.complete(some, out, "bucket", range(buckets), f"{fingerprint}-{buckets}", at_once))


def mark(**parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def score_variants(variants: DataFrame, contigs: DataFrame, load: Callable, distribution: DataFrame, out: str, fingerprint: str, peaks: DataFrame | None = None, width: int = 2114, batch: int = 256, buckets: int = BUCKETS) -> int:
    """``lfc, jsd, active_allele_quantile, ips`` (and ``in_peak``) of every variant that has a window, in buckets of Parquet.

    ``fingerprint`` names inputs and model: another one writes all anew.
    """

    def work(rows: DataFrame) -> DataFrame:
        predicted = inference.predict(inference.with_windows(rows, contigs, width), load, batch)
        return pipelines.score(predicted, distribution, peaks).drop("ref_seq", "alt_seq", "window_error", "ref_logits", "alt_logits")

    return in_buckets(variants, work, out, fingerprint, buckets)


def append_scores(variants: DataFrame, done: str, work: Callable[[DataFrame], DataFrame], key: str = "canonical_id") -> int:
    """Appends ``work`` of the variants whose ``key`` the table ``done`` lacks, each once if rows repeat it; a repeated run appends
    nothing. Returns how many rows that were."""
    spark = variants.sparkSession
    path, fs = sinks._path(spark, done)
    rows = _prepared(variants).dropDuplicates([key])
    there = fs.exists(path)
    if there:
        rows = rows.join(spark.read.parquet(done).select(key).distinct(), key, "left_anti")
    if rows.isEmpty():
        return 0
    # counts of a stored table are read from its files' footers, so the work is done once
    before = spark.read.parquet(done).count() if there else 0
    work(rows).write.mode("append").parquet(done)
    return spark.read.parquet(done).count() - before


def predict_folds(variants: DataFrame, contigs: DataFrame, loads: dict[str, Callable], out: str, fingerprint: str, width: int = 2114, batch: int = 256) -> int:
    """Predictions of each fold's model for every variant that has a window, in ``out/fold=NAME``; complete folds are kept."""
    windows = lambda: inference.with_windows(_prepared(variants), contigs, width)
    return sum(sinks.write_once(inference.predict(windows(), load, batch).drop("ref_seq", "alt_seq", "window_error"), f"{out}/fold={name}", f"{fingerprint}-{name}", f"{out}/_fold-{name}.json") for name, load in sorted(loads.items()))


def attribute_variants(variants: DataFrame, contigs: DataFrame, load: Callable, out: str, fingerprint: str, width: int = 2114, shuffles: int = 20, buckets: int = BUCKETS) -> int:
    """Attributions of both alleles of every variant that has a window, in buckets of Parquet."""
    return in_buckets(variants, lambda rows: inference.attribute(inference.with_windows(rows, contigs, width), load, shuffles), out, fingerprint, buckets)


def contribute_variants(variants: DataFrame, contigs: DataFrame, load: Callable, out: str, fingerprint: str, width: int = 2114, shuffles: int = 20, batch: int = 16, buckets: int = BUCKETS) -> int:
    """Hypothetical and observed contributions of both alleles of every variant that has a window, in buckets of Parquet."""
    return in_buckets(variants, lambda rows: inference.contribute(inference.with_windows(rows, contigs, width), load, shuffles, batch), out, fingerprint, buckets)


#: A fingerprint of files.
files_mark = readers.files_mark
