"""Approximate nearest neighbours along several shifted Hilbert curves.

Inner products are turned into distances by one more coordinate (the norm that a vector lacks to the longest one). Each
curve orders random three-dimensional projections, shifted by a random offset. Its key range is cut into
``SLICES`` slices of equal row counts; ties of keys are broken by a hash, so that many copies of one vector spread too.
A query meets the rows of its own slice and of ``REACH`` neighbours on both sides, on every curve; partial lists
are merged and ranked by exact inner products. The window is a share of the rows, so recall does not fall as the
table grows. Vectors without any structure (a uniform sphere in 64 dimensions) need wide windows, so that the work and what is
shuffled grow with queries times rows, as in brute force; for clustered vectors ``slices`` can be raised with the table, and both
then grow with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays as wa
from genoframe.llm.embedding_dedup import one_row_an_id, vectors
from genoframe.llm.scratch import Scratch
from genoframe.llm.tiles import map_runs
from genoframe.llm.workers import tidy

CURVES, DIMENSIONS, BITS = 8, 3, 10
SLICES, REACH, SLICE_ROWS = 32, 3, 4
#: Rows and queries that meet in one task, about; queries that are multiplied at once.
ROW_BLOCK, QUERY_BLOCK, QUERY_STEP = 16384, 8192, 512


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (n x d) below 2^bits, most significant bit first.

    From coarse to fine, each level's bits say which orthant a cell lies in and how the curve inside is reflected
    (invert the first axis) or turned (swap with the first axis); what is left is a Gray code of the place.
    """
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in range(len(x)):
            upper = (x[axis] >> level) & 1 == 1
            swapped = np.where(upper, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(upper, below, swapped)
            if axis:
                x[axis] ^= swapped
    key = np.zeros(x.shape[1], np.int64)
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            parity ^= (x[axis] >> level) & 1
            key = key << 1 | parity
    return key


def curve_keys(v: np.ndarray, longest: float, ids: np.ndarray) -> np.ndarray:
    """Keys (n x CURVES): the place on each curve, then 31 bits of a hash of the id against ties."""
    w = v / longest
    lack = np.sqrt(np.maximum(0.0, 1.0 - (w * w).sum(1)))
    w = np.column_stack([w, lack])
    out = np.zeros((len(v), CURVES), np.int64)
    for c in range(CURVES):
        rng = np.random.default_rng([c, w.shape[1]])
        axes = np.linalg.qr(rng.standard_normal((w.shape[1], min(DIMENSIONS, w.shape[1]))))[0]
        at = (w @ axes + 1.0 + rng.random(axes.shape[1]) / 4) / 2.25
        cells = np.clip(at * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
        out[:, c] = hilbert_keys(cells, BITS) << 31 | (wa.mix(ids.view(np.uint64) + np.uint64(c)) >> np.uint64(33)).view(np.int64)
    return out


def _usable(df: DataFrame) -> DataFrame:
    """``vec_id, dim, norm, v``: vectors that take part, as doubles of their own values."""
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("dim", T.IntegerType()), T.StructField("norm", T.DoubleType()), T.StructField("v", df.schema["embedding"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = vectors(batch.column(1))
            norm = [np.abs(v).max() * np.sqrt(((v / np.abs(v).max()) ** 2).sum()) for v in vs]
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([len(v) for v in vs], pa.int32()), pa.array(norm, pa.float64()), batch.column(1).take(at)], schema.fieldNames())

    return df.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(tidy(run), schema)


def _keyed(rows: DataFrame, longest: float) -> DataFrame:
    schema = T.StructType([rows.schema["vec_id"], rows.schema["dim"], rows.schema["v"], T.StructField("keys", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ids = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                here = batch.column(2).take(pa.array(at))
                v = here.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(at), dim)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * CURVES, pa.int32()), pa.array(curve_keys(v, longest, ids[at]).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(dims[at]), here, keys], schema.fieldNames())

    return rows.select("vec_id", "dim", "v").mapInArrow(tidy(run), schema)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component to the last: equal vectors always give equal sums."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def _nearest(q: np.ndarray, qv: np.ndarray, r: np.ndarray, rv: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, inner product) of the ``k`` rows nearest to each query."""
    rough = qv @ rv.T
    rough[q[:, None] == r[None, :]] = -np.inf
    if rough.shape[1] > k:
        least = np.partition(rough, -k, axis=1)[:, -k]
        # rounding may order near ties otherwise than the exact sums below
        margin = 1e-12 * (np.linalg.norm(qv, axis=1) * np.linalg.norm(rv, axis=1).max())
        near = rough >= np.maximum(least - margin, -np.finfo(float).max)[:, None]
    else:
        near = rough > -np.inf
    a, b = np.nonzero(near)
    score = inner_products(qv[a], rv[b])
    order = np.lexsort((r[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return q[a[keep]], r[b[keep]], score[keep]


def _best(k: int):
    def apply(t: pa.Table) -> list[pa.Array] | None:
        asks = t["asks"].to_numpy(zero_copy_only=False)
        if asks.all() or not asks.any():
            return None
        ids = t["vec_id"].to_numpy()
        v = t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1)
        q, qv, r, rv = ids[asks], v[asks], ids[~asks], v[~asks]
        out = [_nearest(q[x : x + QUERY_STEP], qv[x : x + QUERY_STEP], r, rv, k) for x in range(0, len(q), QUERY_STEP)]
        return [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]

    return apply


def nearest(df: DataFrame, is_query, scratch: Scratch, k: int = 20, slices: int = SLICES, reach: int = REACH) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each usable row of ``df(vec_id, embedding)`` with ``is_query`` (a column
    on vec_id) its ``k`` nearest found by inner product, nearest first, ties to the smaller vec_id.

    Vectors that are null, empty, zero or hold a null or non-finite component, and null ids, take no part; vectors of
    other dimensions are no candidates; rows that repeat an id count once, as the smallest of their vectors; an empty table gives no rows; with ``k``
    or fewer candidates in reach all are returned. Other columns are not read.
    """
    rows = one_row_an_id(scratch.put(_usable(df), "usable"))
    longest, n, asking = rows.agg(F.max("norm"), F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("long")), F.lit(0))).first()
    keyed = scratch.put(_keyed(rows, longest or 1.0), "keyed")
    places = keyed.select("vec_id", "dim", F.posexplode("keys").alias("curve", "key"))
    cuts = F.percentile_approx("key", [i / slices for i in range(1, slices)], 10_000)
    # slices hold SLICE_ROWS times k rows at least: a table of few rows has fewer slices
    every_nth = lambda n: max(1, -(-slices * SLICE_ROWS * k // n))
    bounds = {(r.dim, r.curve): r.cuts[every_nth(r.n) - 1 :: every_nth(r.n)] for r in places.groupBy("dim", "curve").agg(cuts.alias("cuts"), F.count(F.lit(1)).alias("n")).collect()}
    if not bounds:
        schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
        return df.sparkSession.createDataFrame([], schema)
    table = df.sparkSession.createDataFrame([(d, c, list(cut)) for (d, c), cut in bounds.items()], "dim int, curve int, cuts array<bigint>")
    # one row of slices - 1 numbers for each curve and dimension
    sliced = places.join(F.broadcast(table), ["dim", "curve"]).select("vec_id", "dim", "curve", F.size(F.filter("cuts", lambda x: x < F.col("key"))).alias("slice"))
    row_blocks = max(1, -(-n // (slices * ROW_BLOCK)))
    query_blocks = max(1, -(-asking * (2 * reach + 1) // (slices * QUERY_BLOCK)))
    part = lambda salt, blocks: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    held = sliced.withColumn("asks", F.lit(False)).withColumn("rb", part("rows", row_blocks)).withColumn("qb", every(query_blocks))
    asked = sliced.where(is_query).withColumn("slice", F.explode(F.sequence(F.col("slice") - reach, F.col("slice") + reach))).where(f"slice BETWEEN 0 AND {slices - 1}")
    asked = asked.withColumn("asks", F.lit(True)).withColumn("qb", part("queries", query_blocks)).withColumn("rb", every(row_blocks))
    tiles = held.unionByName(asked).select("vec_id", "asks", F.xxhash64("dim", "curve", "slice", "rb", "qb").alias("tile"))
    both = tiles.join(keyed.select("vec_id", "v"), "vec_id")
    found = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    lists = map_runs(both, "tile", _best(k), found)
    place = F.expr("dense_rank() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")
    # several curves find the same neighbour: with one exact score, so it has one place
    return lists.withColumn("rank", place).where(F.col("rank") <= k).dropDuplicates(["query_id", "rank"]).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
