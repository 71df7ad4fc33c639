"""Left joins and point lookups on exact allele keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLELE = ["chrom", "pos", "ref", "alt"]


def left_lookup(variants: DataFrame, table: DataFrame, columns: list[str], keys: list[str] = ALLELE) -> DataFrame:
    """All variant rows with ``columns`` of every matching table row, null without one."""
    return variants.join(table.select(*keys, *columns), keys, "left")


def lookup_stats(joined: DataFrame, matched: str, key: str) -> DataFrame:
    """``matched_rows, matched_variants, output_rows`` of a left lookup."""
    hit = F.col(matched).isNotNull()
    return joined.agg(F.count_if(hit).alias("matched_rows"), F.count_distinct(F.when(hit, F.col(key))).alias("matched_variants"), F.count(F.lit(1)).alias("output_rows"))


def prune_partitions(table: DataFrame, chromosomes: list[str], column: str = "CHROM") -> DataFrame:
    """The table's partitions of the chromosomes asked for; the filter reaches the scan's partition directories."""
    return table.where(F.col(column).isin(chromosomes))


def last_frequency(listed: Column, population: str) -> Column:
    """Frequency of the last entry for a population in an array of ``(population, frequency)``, to three decimals; absent or null is 0."""
    own = F.filter(listed, lambda e: e["population"] == population)
    return F.coalesce(F.bround(F.try_element_at(own, F.lit(-1))["frequency"], 3), F.lit(0.0))


def flatten_frequencies(df: DataFrame, listed: str, populations: list[str]) -> DataFrame:
    """A column ``af_<population>`` for each population."""
    return df.select(*[c for c in df.columns if c != listed], *[last_frequency(F.col(listed), p).alias(f"af_{p}") for p in populations])


def frequency_lookup(variants: DataFrame, frequencies: DataFrame, keys: list[str]) -> DataFrame:
    """All variant rows, whether they are known (``in_ot``), and the frequencies, 0 if not."""
    values = [c for c in frequencies.columns if c not in keys]
    joined = variants.join(frequencies.withColumn("_known", F.lit(True)), keys, "left")
    return joined.select(*variants.columns, F.coalesce("_known", F.lit(False)).alias("in_ot"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in values])


def snv_or_indel(ref: Column, alt: Column) -> Column:
    return F.when((F.length(ref) == 1) & (F.length(alt) == 1), "SNV").otherwise("INDEL")


def two_table_lookup(variants: DataFrame, snv: DataFrame, indel: DataFrame, score: str, order: str) -> DataFrame:
    """Adds ``kind`` and ``score``: from the table of the variant's kind, the first exact match in ``order``."""
    one = lambda t, kind: t.groupBy(*ALLELE).agg(F.min_by(score, order).alias("score")).withColumn("kind", F.lit(kind))
    both = one(snv, "SNV").unionByName(one(indel, "INDEL"))
    return variants.withColumn("kind", snv_or_indel(F.col("ref"), F.col("alt"))).join(both, [*ALLELE, "kind"], "left")


def not_done(variants: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Variants that are not yet among the scored ones."""
    return variants.join(done.select(key).distinct(), key, "left_anti")
