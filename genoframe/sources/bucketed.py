"""Bucketed and sorted Parquet at a path of its own, so that joins and grouping by its keys leave its rows where they are."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from genoframe.sources import sinks


def write(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, **more) -> DataFrame:
    """Stores ``df`` in buckets of ``keys``, as many as the session's shuffle partitions unless told, sorted by them, a file a bucket, and
    gives it back. ``more`` is kept beside it, in ``path.index.json``; ``read`` opens the table in another session."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stored_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    sinks.write_manifest(spark, f"{path}.index.json", {"keys": keys, "buckets": buckets, "schema": json.loads(df.schema.json()), **more})
    return read(spark, path)[0]


def read(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(the stored table, what is kept beside it); the table that stands for the files is named anew in each call."""
    told = sinks.read_manifest(spark, f"{path}.index.json")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(told["schema"]).fields)
    name, keys = f"stored_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in told["keys"])
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name), told
