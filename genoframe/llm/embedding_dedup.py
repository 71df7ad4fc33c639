"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines, connected components.

The number of sign bits follows from the number of vectors, so that buckets stay small at any size, and the
number of tables from the bits, so that a pair at the threshold is missed with probability ``MISS`` at every size.
Equal vectors of a label are one class, compared once. Buckets beyond ``BLOCK`` classes are compared block against block,
each pair of blocks in a task's own tile: no bucket is capped and none meets in one task. A tile gives link counts and a spanning
forest of its links, not the pairs.
A pair that shares several tables is looked at only in the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays as wa
from genoframe.llm.components import connected_components
from genoframe.llm.scratch import Scratch
from genoframe.llm.tiles import map_runs
from genoframe.llm.workers import tidy

MISS = 1e-5
#: Classes of a bucket that one side of a tile holds at most, about.
BLOCK = 512
#: Of the random hyperplanes.
SEED = 7


def plan(n: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for ``n`` vectors: about one unrelated vector a bucket, and a miss rate of at most MISS.

    Bits grow with the logarithm of ``n`` without a cap, up to the 62 that a code holds (4 * 10^18 vectors)."""
    bits = min(62, max(8, math.ceil(math.log2(max(n, 2)))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


def vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers and double vectors of the rows that are not null, not zero and wholly finite."""
    rows, out = [], []
    column = column.cast(pa.large_list(pa.float64())) if not pa.types.is_float64(column.type.value_type) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # null components become NaN
    for k in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
        v = values[offsets[k] : offsets[k + 1]]
        if len(v) and np.isfinite(v).all() and v.any():
            rows.append(k)
            out.append(v)
    return np.array(rows, np.int64), out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def one_row_an_id(df: DataFrame) -> DataFrame:
    """``df`` with one row for each ``vec_id``: of rows that repeat one, that with the smallest other columns, in their order.

    Only ids are shuffled to see whether any is repeated; whole rows only of those that are.
    """
    repeated = df.groupBy("vec_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("vec_id")
    if repeated.isEmpty():
        return df
    rest = [c for c in df.columns if c != "vec_id"]
    chosen = df.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct(*rest)).alias("r"))
    return df.join(repeated, "vec_id", "left_anti").select(df.columns).unionByName(chosen.select("vec_id", "r.*"))


def hashed(df: DataFrame, bits: int, tables: int) -> DataFrame:
    """``vec_id, unit, group, codes`` of usable vectors with a label: group hashes label and dimension."""
    schema = T.StructType([df.schema["vec_id"], T.StructField("unit", T.ArrayType(T.DoubleType(), False)), T.StructField("group", T.LongType()), T.StructField("codes", T.ArrayType(T.IntegerType() if bits < 32 else T.LongType(), False))])
    kind = np.int32 if bits < 32 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = vectors(batch.column(1))
            by_dim: dict[int, list[int]] = {}
            for k, v in enumerate(vs):
                by_dim.setdefault(len(v), []).append(k)
            labels = batch.column(2).to_numpy(zero_copy_only=False)
            for dim, at in by_dim.items():
                unit = _unit(np.stack([vs[k] for k in at]))
                planes = np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))
                signs = (unit @ planes > 0).reshape(len(at), tables, bits)
                codes = (signs * (1 << np.arange(bits))).sum(2).astype(kind)
                own = rows[at]
                group = wa.mix(labels[own].astype(np.int64).view(np.uint64) * np.uint64(31) + np.uint64(dim)).view(np.int64)
                steps = lambda width, n=len(at): pa.array(np.arange(n + 1) * width, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), pa.ListArray.from_arrays(steps(dim), pa.array(unit.ravel())), pa.array(group), pa.ListArray.from_arrays(steps(tables), pa.array(codes.ravel()))],
                    schema.fieldNames(),
                )

    return df.where("label IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", "embedding", F.xxhash64("label").alias("label")).mapInArrow(tidy(run), schema)


def _forest(adjacent: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row of its component."""
    n = len(adjacent)
    root = np.full(n, -1)
    for k in range(n):
        if root[k] < 0:
            reached = np.zeros(n, bool)
            reached[k] = True
            front = reached
            while front.any():
                front = adjacent[front].any(0) & ~reached
                reached |= front
            root[reached] = k
    return root


def _tile(threshold: float):
    def apply(t: pa.Table) -> list[pa.Array] | None:
        ids = t["vec_id"].to_numpy()
        n = len(ids)
        table, side = t["table"][0].as_py(), t["side"].to_numpy()
        codes = t["codes"].combine_chunks().flatten().to_numpy().reshape(n, -1)[:, :table]
        unit = t["unit"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        times = t["times"].to_numpy().astype(float)
        near = unit @ unit.T >= threshold
        np.fill_diagonal(near, False)
        if side.any():  # two blocks: pairs within one are another tile's
            near &= side[:, None] != side[None, :]
        a, b = np.nonzero(near)
        for at in range(0, len(a), 1 << 18):  # a pair that met in an earlier table is counted there
            s = slice(at, at + (1 << 18))
            near[a[s], b[s]] = ~(codes[a[s]] == codes[b[s]]).any(1)
        links = near @ times
        if not links.any():
            return None
        root = ids[_forest(near)]
        some = links > 0
        return [pa.array(ids[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))]

    return apply


def near_duplicates(df: DataFrame, scratch: Scratch, threshold: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df(vec_id, embedding, label)``.

    Vectors with equal, non-null labels and a cosine of ``threshold`` or more are linked. Vectors that are null, empty,
    zero or hold a null or non-finite component, null labels, null ids and different dimensions link with nothing: 0 links, their
    own component, kept. ``vec_id`` names rows: rows that repeat an id count as one vector, that of the smallest unit vector, and
    each has that one's result. An empty table gives no rows; other columns are not read.
    """
    bits, tables = plan(df.count(), threshold)
    rows = scratch.put(hashed(df, bits, tables), "codes")
    rows = one_row_an_id(rows).withColumns({"set_a": F.xxhash64("unit"), "set_b": F.xxhash64(F.lit(1), "unit")})
    same = ["group", "set_a", "set_b"]
    classes = scratch.put(rows.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("times"), F.first("codes").alias("codes"), F.first("unit").alias("unit")), "classes")
    entry = classes.select("rep", "group", F.posexplode("codes").alias("table", "code")).select("rep", "table", F.xxhash64("group", "table", "code").alias("bucket"))
    full = scratch.put(entry.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    placed = entry.join(full, "bucket").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("rep", "bucket"), F.col("blocks")).cast("int"))
    # every pair of blocks is a tile; a block goes to the tiles of its row and its column
    tiled = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = tiled.withColumn("tile", F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))).withColumn("side", F.col("block") > F.col("other"))
    both = tiled.select("rep", "table", "tile", "side").join(classes.select("rep", "times", "codes", "unit"), "rep").withColumnRenamed("rep", "vec_id")
    schema = T.StructType([T.StructField("a", rows.schema["vec_id"].dataType), T.StructField("b", rows.schema["vec_id"].dataType), T.StructField("links", T.LongType())])
    found = scratch.put(map_runs(both, "tile", _tile(threshold), schema), "links")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("a", "b"), scratch)
    of = classes.select(*same, "rep", "times").join(counts, "rep", "left").join(parts, F.col("rep") == F.col("id"), "left")
    of = of.select(*same, (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    named = rows.select("vec_id", *same).join(of, same).select("vec_id", "n_links", "component")
    out = df.select("vec_id").join(named, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
