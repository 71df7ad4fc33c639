"""Writers: tables, Parquet shards with a manifest, category folders, JSON lines, augmented VCF."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.operators import augment


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_tsv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite", compression: str = "none") -> None:
    df.write.mode(mode).option("sep", "\t").option("header", header).option("compression", compression).option("emptyValue", "").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Every field in every line, nulls too."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_categories(routed: DataFrame, path: str, categories) -> dict[str, int]:
    """A folder of headerless tables for each requested category, an empty one for a category without rows; counts of all.

    Rows are routed once: the counts are those of what was written.
    """
    from genoframe.operators.regions import checked

    spark = routed.sparkSession
    names = checked(categories)
    routed.write.mode("overwrite").partitionBy("category").option("sep", "\t").option("emptyValue", "").csv(path)
    counts = dict.fromkeys(names, 0)
    for name in names:
        folder, fs = _path(spark, f"{path}/category={name}")
        if not fs.exists(folder):
            fs.mkdirs(folder)
            fs.create(_path(spark, f"{path}/category={name}/part-00000.csv")[0], True).close()
    counts |= {r.category: r["count"] for r in spark.read.text(path).groupBy("category").count().collect()}
    return counts


def write_hive(df: DataFrame, path: str, partition: str = "CHROM", sort=("POS",)) -> None:
    """Zstandard Parquet partitioned by chromosome and sorted, so that scans prune folders and row groups.

    Rows of a chromosome are ranged over several tasks by position, not dealt to one.
    """
    df.repartitionByRange(partition, *sort).sortWithinPartitions(partition, *sort).write.mode("overwrite").option("compression", "zstd").partitionBy(partition).parquet(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """JSON with sorted keys; written beside its place and moved there, so it is whole or absent."""
    p, fs = _path(spark, path)
    tmp, _ = _path(spark, path + ".tmp")
    stream = fs.create(tmp, True)
    stream.write(bytearray(json.dumps(manifest, sort_keys=True, indent=2).encode()))
    stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(tmp, p)


def folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names in ``path`` that match ``pattern``."""
    p, fs = _path(spark, f"{path}/{pattern}")
    return sorted(x.getPath().getName() for x in fs.globStatus(p) or [])


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_once(df: DataFrame, path: str, fingerprint: str, manifest: str | None = None) -> bool:
    """Writes ``df`` unless a run with the same fingerprint has; the manifest, beside the folder if nowhere else, comes last and
    completes it: rows, and of each file its name, size, rows and the digest of what it holds. True if written."""
    from genoframe.sources import shards

    spark = df.sparkSession
    manifest = manifest or f"{path}.manifest.json"
    old = read_manifest(spark, manifest)
    if old is not None and old["fingerprint"] == fingerprint:
        return False
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    files = [r.asDict() for r in back.groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes")).agg(*shards.digest(back)).orderBy("name").collect()]
    write_manifest(spark, manifest, {"fingerprint": fingerprint, "rows": sum(f["rows"] for f in files), "shards": files})
    return True


#: Records of a part of an augmented VCF, at least, while there are fewer parts than shuffle partitions.
PART = 1 << 14


def write_augmented_vcf(header: list[str], records: DataFrame, annotations: DataFrame, path: str, prefix: str) -> None:
    """VCF text with the annotation fields of ``annotations(record_ordinal, <fields>)``, in record order.

    Fields of an earlier run are replaced, so writing twice changes nothing. The parts' first carries the header. Block
    compression and an index have no writer here: the text may be gzipped by Spark. Ordinals say which part a record goes to, so
    the join is not made a second time to learn how they are spread.
    """
    spark = records.sparkSession
    fields = [f for f, *_ in augment.INFO_FIELDS if f in annotations.columns]
    joined = records.join(annotations, "record_ordinal", "left")
    old = augment.without_own_info(F.coalesce("info", F.lit(".")), prefix)
    new = augment.info_text(joined, fields, prefix)
    info = F.when(new == "", old).when(old == ".", new).otherwise(F.concat(old, F.lit(";"), new))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.coalesce("variant_id", F.lit(".")), "ref", "alt_raw", F.coalesce("qual", F.lit(".")) if "qual" in records.columns else F.lit("."), F.coalesce("filter", F.lit(".")) if "filter" in records.columns else F.lit("."), info, F.col("format"), F.when(F.size("samples") > 0, F.array_join("samples", "\t")))
    head = records.sparkSession.createDataFrame([(i - len(header), x) for i, x in enumerate(header)], "record_ordinal long, value string")
    both = head.unionByName(joined.select("record_ordinal", line.alias("value")))
    n = (records.agg(F.max("record_ordinal")).first()[0] or 0) + 1
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PART))
    part = F.greatest(F.expr(f"record_ordinal * {parts} div {n}"), F.lit(0).cast("long")).cast("int")
    both.repartitionById(parts, part).sortWithinPartitions("record_ordinal").select("value").write.mode("overwrite").text(path)
