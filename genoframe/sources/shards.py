"""Partitioned Parquet that a repeated run completes: what is there and sound stays, what is missing, damaged or of another plan goes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.sources import sinks


def digest(rows: DataFrame) -> tuple[Column, Column]:
    """(number of rows, digest) as aggregates: the digest is that of the rows' count, sum and parity of hashes, in whatever order and
    files they are, so it is made where the rows are and no file is held."""
    hashed = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() else F.col(f.name) for f in rows.schema.fields]
    h, n = F.xxhash64(*hashed), F.count(F.lit(1))
    return n.alias("rows"), F.sha2(F.concat_ws(":", n.cast("string"), F.sum(h.cast("decimal(20,0)")).cast("string"), F.bit_xor(h).cast("string")), 256).alias("digest")


def _sound(spark: SparkSession, path: str, by: str, among: Iterable[int] | None = None) -> dict[str, list]:
    """Rows and digest of each partition that is there; files that cannot be read count as empty."""
    try:
        found = spark.read.option("ignoreCorruptFiles", True).parquet(path)
    except Exception as e:  # a folder without one sound file has no schema
        if "UNABLE_TO_INFER_SCHEMA" not in str(e) and "PATH_NOT_FOUND" not in str(e) and "CANNOT_READ_FILE_FOOTER" not in str(e) and "FAILED_READ_FILE" not in str(e):
            raise
        return {}
    if by not in found.columns:
        return {}
    if among is not None:
        found = found.where(F.col(by).isin(*among))
    return {str(r[by]): [r.rows, r.digest] for r in found.groupBy(by).agg(*digest(found.drop(by))).collect()}


def complete(work: Callable[[list[int]], DataFrame], path: str, by: str, numbers: Iterable[int], fingerprint: str, at_once: int | None = None) -> list[int]:
    """Writes the partitions ``by=N`` of ``numbers`` that ``path`` does not hold, or holds otherwise than its manifests say, and returns them.

    ``work`` gives the rows of some partitions, their number in the column ``by``. All that is missing is written in one job, or in
    jobs of ``at_once`` partitions, each a point from which a stopped run goes on. Each partition has a manifest, ``_by-N.json``, with the
    fingerprint of the plan, the number of rows and their digest; a partition may be empty. Partitions with another fingerprint are
    written anew, those that the plan lacks are deleted.
    """
    numbers = sorted(numbers)
    spark = SparkSession.active()
    manifest = lambda n: f"{path}/_{by}-{n}.json"
    told = {n: sinks.read_manifest(spark, manifest(n)) for n in numbers}
    known = {n: [m["rows"], m["digest"]] for n, m in told.items() if m is not None and m["fingerprint"] == fingerprint}
    found = _sound(spark, path, by) if known else {}
    nothing = [0, None]
    kept = {str(n) for n, own in known.items() if found.get(str(n), nothing) == own}
    missing = [n for n in numbers if str(n) not in kept]
    # folders and manifests of partitions that are to be written, or of none: what is empty now would not be replaced
    for pattern, number in ((f"{by}=*", lambda x: x.partition("=")[2]), (f"_{by}-*.json", lambda x: x[len(by) + 2 : -5])):
        for name in sinks.folders(spark, path, pattern):
            if number(name) not in kept:
                sinks.delete(spark, f"{path}/{name}")
    step = at_once or len(missing) or 1
    for k in range(0, len(missing), step):
        some = missing[k : k + step]
        work(some).hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(by).parquet(path)
        written = _sound(spark, path, by, some)
        for n in some:
            rows, content = written.get(str(n), nothing)
            sinks.write_manifest(spark, manifest(n), {"fingerprint": fingerprint, "rows": rows, "digest": content})
    return missing
