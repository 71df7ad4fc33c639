"""Near-duplicates by one-permutation hashing with optimal densification, bands and star-shaped candidate edges.

1. A map computes each text's distinct 5-word shingles and a signature of ``BINS`` bins from one hash of each shingle;
   an empty bin takes the value of the first filled bin in its own random order (optimal densification).
2. Texts with the same set collapse into one class.
3. Bands of ``ROWS`` bins make buckets. In each, edges lead from one centre, the same for most bands of
   a group, to the members. Each member is first compared with its best centre only: an edge a member, not all pairs.
4. Edges are confirmed on full sets. What its best centre does not take is compared with the centres of its other buckets that
   are still in other components. Texts that then meet another component in a bucket are joined exactly, by prefix
   and position filters on their full sets, so that no link is lost to the stars.
5. Components of the confirmed links; links found later extend them on the graph of components.

A pair of similarity 0.75 shares a bucket with probability 1 - (1 - 0.75^5)^48 > 0.999997.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays as wa
from genoframe.llm.components import connected_components, extended
from genoframe.llm.scratch import Scratch
from genoframe.llm.workers import tidy

SHINGLE_WORDS, PERCENT = 5, 75
BANDS, ROWS = 48, 5
BINS = BANDS * ROWS
#: Attempts made for all empty bins together; the few left are found from the ranks of the filled bins.
ATTEMPTS = 16
#: A list of up to so many ids (8 bytes each) is broadcast to pick texts; a longer one is joined by shuffle.
BROADCAST_IDS = 1_000_000
_order = np.stack([np.random.default_rng(1000 + i).permutation(BINS) for i in range(BINS)]).astype(np.int16)
_rank = np.argsort(_order, axis=1).astype(np.int16)


def densified(doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """Signatures (n_docs x BINS) of sets given as sorted (text number, hash); rows of empty sets are undefined."""
    bin_ = (((value >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    cell = doc * BINS + bin_
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    sig, filled = np.zeros(n_docs * BINS, np.uint64), np.zeros(n_docs * BINS, bool)
    sig[cell[first]], filled[cell[first]] = value[first], True
    sig, filled = sig.reshape(n_docs, BINS), filled.reshape(n_docs, BINS)
    rows, cols = np.nonzero(~filled & filled.any(1)[:, None])
    for attempt in range(ATTEMPTS):
        near = _order[cols, attempt]
        hit = filled[rows, near]
        sig[rows[hit], cols[hit]] = sig[rows[hit], near[hit]]
        rows, cols = rows[~hit], cols[~hit]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    for a, b in zip(starts, np.append(starts, len(rows))[1:], strict=True):
        there = np.flatnonzero(filled[rows[a]])
        sig[rows[a], cols[a:b]] = sig[rows[a], there[np.argmin(_rank[cols[a:b]][:, there], axis=1)]]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    for k in range(ROWS):
        out = wa.mix(out * np.uint64(5) + sig[:, k::ROWS])
    return out


def _listed(bounds: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))


def _digests(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of each set, from sums over its members and its size."""
    size = np.diff(bounds).astype(np.uint64)
    sums = np.zeros((2, len(value) + 1), np.uint64)
    np.cumsum(wa.mix(value), out=sums[0, 1:])
    np.cumsum(wa.mix(~value), out=sums[1, 1:])
    one, two = (wa.mix((s[bounds[1:]] - s[bounds[:-1]]) + size).view(np.int64) for s in sums)
    return one, two


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands``: two independent 64-bit digests name the set; null without words."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_shingles", T.LongType()), T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wa.chunks(batch.column(1)):
                doc, value = wa.shingles(wa.words(data, offsets), SHINGLE_WORDS)
                n = end - first
                bounds = np.searchsorted(doc, np.arange(n + 1))
                size = np.diff(bounds)
                named = [pa.array(d, mask=size == 0) for d in _digests(value, bounds)]
                some = np.flatnonzero(size)
                keys = np.zeros((n, BANDS), np.uint64)
                keys[some] = band_keys(densified(doc, value, n)[some])
                ends = np.zeros(n + 1, np.int64)
                np.cumsum(np.where(size, BANDS, 0), out=ends[1:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(size, pa.int64()), *named, _listed(ends, keys[some].ravel())], schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``cls, shingles``: each text's whole set as sorted 64-bit hashes, and the digest ``set_a`` that names it."""
    schema = T.StructType([T.StructField("cls", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wa.chunks(batch.column(0)):
                doc, value = wa.shingles(wa.words(data, offsets), SHINGLE_WORDS)
                bounds = np.searchsorted(doc, np.arange(end - first + 1))
                yield pa.RecordBatch.from_arrays([pa.array(_digests(value, bounds)[0]), _listed(bounds, value)], schema.fieldNames())

    return docs.select("text").mapInArrow(tidy(run), schema)


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _star_edges(shared: DataFrame) -> DataFrame:
    """``hot, hot_rep, cold, cold_rep, rank``: from the centre of each bucket to all its members whose sizes allow a link.

    The centre is the member with the most neighbours, over all its buckets; in a group of mutated copies that is the text that
    is most like the others, and it is the same in all the group's buckets. ``rank`` orders the centres of a member.
    """
    degree = shared.groupBy("cls").agg(F.sum("members").alias("degree"))
    rows = shared.join(degree, "cls")
    centre = rows.groupBy("key").agg(F.max(F.struct("degree", F.xxhash64("cls").alias("tie"), F.col("cls").alias("hot"), F.col("rep").alias("hot_rep"), F.col("n").alias("hot_n"))).alias("c"))
    edges = shared.join(centre.select("key", "c.*"), "key").where("hot <> cls").where(_sizes_allow(F.col("hot_n"), F.col("n")))
    return edges.groupBy("hot", "hot_rep", F.col("cls").alias("cold"), F.col("rep").alias("cold_rep")).agg(F.max("degree").alias("degree"), F.max("tie").alias("tie"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``hot, hot_rep, cold, cold_rep, linked`` of the pairs, on full sets.

    The set of the end that many pairs have joins first, to narrow rows, so no wide rows meet on a hot key.
    """
    one = sets.select(F.col("cls").alias("hot"), F.col("shingles").alias("hot_set"))
    two = sets.select(F.col("cls").alias("cold"), F.col("shingles").alias("cold_set"))
    both = pairs.select("hot", "hot_rep", "cold", "cold_rep").join(one, "hot").join(two, "cold")
    shared = both.select("hot", "hot_rep", "cold", "cold_rep", F.size(F.array_intersect("hot_set", "cold_set")).cast("long").alias("shared"), (F.size("hot_set") + F.size("cold_set")).cast("long").alias("sizes"))
    return shared.select("hot", "hot_rep", "cold", "cold_rep", (F.col("shared") * 100 >= (F.col("sizes") - F.col("shared")) * PERCENT).alias("linked"))


def _links(tested: DataFrame) -> DataFrame:
    return tested.where("linked").select(F.col("hot_rep").alias("a"), F.col("cold_rep").alias("b"))


def _sets_of(docs: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Sets of the texts of some ids, once for each different set."""
    ids = scratch.put(reps.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return scratch.put(shingle_sets(docs.join(wanted, "doc_id", "left_semi")).groupBy("cls").agg(F.first("shingles").alias("shingles")), "sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("hot_rep", "cold_rep")).alias("rep"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    out = pairs
    for end in ("hot", "cold"):
        out = out.join(found.select(F.col("id").alias(f"{end}_rep"), F.col("component").alias(f"{end}_in")), f"{end}_rep", "left")
    return out.where(F.coalesce("hot_in", "hot_rep") != F.coalesce("cold_in", "cold_rep")).drop("hot_in", "cold_in")


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Documents are linked if 100 * shared >= 75 * united of their sets; ``component_id`` is the smallest doc_id
    reachable. Null, empty and blank texts have no shingles, link with nothing and are kept. Rows that repeat a ``doc_id``
    are one document: with one text they are in one component, and with several each text's links are the document's,
    as far as that id is the smallest with the text. A null ``doc_id`` never represents a class that has another id. An
    empty table gives no rows; other columns are not read.
    """
    marked = scratch.put(signatures(docs), "signatures")
    classes = scratch.put(
        marked.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    buckets = classes.where("rep IS NOT NULL").select(F.explode("bands").alias("key"), F.col("set_a").alias("cls"), "rep", "n")
    several = scratch.put(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "several")
    shared = scratch.put(buckets.join(several, "key"), "shared")
    stars = scratch.put(_star_edges(shared), "stars")
    scratch.drop(several)
    best = F.max(F.struct("degree", "tie", "hot", "hot_rep")).alias("c")
    first = scratch.put(stars.groupBy("cold", "cold_rep").agg(best).select("c.hot", "c.hot_rep", "cold", "cold_rep"), "first")
    sets = _sets_of(docs, _ends(first), scratch)
    tested = scratch.put(_confirmed(first, sets), "tested")
    scratch.drop(sets, first)
    found = scratch.put(connected_components(_links(tested), scratch), "components")
    # the other centres of what its best centre did not take
    again = _apart(stars, found).join(tested, ["hot", "cold"], "left_anti").join(tested.select(F.col("hot").alias("cold"), F.col("cold").alias("hot")), ["hot", "cold"], "left_anti")
    again = scratch.put(again.select("hot", "hot_rep", "cold", "cold_rep"), "again")
    sets = _sets_of(docs, _ends(again), scratch)
    second = scratch.put(_confirmed(again, sets), "second")
    scratch.drop(sets, again, stars)
    found = extended(found, _links(second), scratch)
    split = scratch.put(_split(shared, found), "split")
    sets = _sets_of(docs, split, scratch)
    rest = scratch.put(_pairs_left(split, sets, tested.unionByName(second), scratch), "left")
    found = extended(found, _links(scratch.put(_confirmed(rest, sets), "more")), scratch)
    named = classes.join(found, F.col("rep") == F.col("id"), "left").select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    named = scratch.put(named, "named")
    out = marked.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _split(shared: DataFrame, found: DataFrame) -> DataFrame:
    """``cls, rep, component`` of what meets another component in some bucket."""
    placed = shared.join(found, F.col("rep") == F.col("id"), "left").select("key", "cls", "rep", F.coalesce("component", "rep").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return placed.join(split, "key", "left_semi").select("cls", "rep", "component").distinct()


def _pairs_left(split: DataFrame, sets: DataFrame, tested: DataFrame, scratch: Scratch) -> DataFrame:
    """``hot, hot_rep, cold, cold_rep``: all untested pairs of different components that can be similar, by prefixes and positions.

    Each set is ordered from rare to frequent shingles. Two similar sets share a shingle among the first 25% of each, and
    the first one they share leaves enough of both behind it. So a passage that many texts share makes no pairs:
    it stands at the end of every set. Shingles that no other set has only shift the positions.
    """
    sized = sets.select("cls", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    often = scratch.put(sized.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "often")
    rank = F.expr("row_number() OVER (PARTITION BY cls ORDER BY f, s)")
    inside = F.expr("count(1) OVER (PARTITION BY cls)")
    placed = sized.join(often, "s").select("cls", "s", "n", (F.col("n") - inside + rank).alias("at"))
    prefix = placed.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    prefix = scratch.put(prefix.join(split, "cls").select("s", "cls", "rep", "component", "n", "at"), "prefix")
    left, right = (prefix.select("s", F.col("cls").alias(x), F.col("rep").alias(f"{x}_rep"), F.col("component").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"), F.col("at").alias(f"at_{x}")) for x in ("hot", "cold"))
    most = 1 + F.least(F.col("n_hot") - F.col("at_hot"), F.col("n_cold") - F.col("at_cold"))
    able = most * (100 + PERCENT) >= (F.col("n_hot") + F.col("n_cold")) * PERCENT
    cross = left.join(right, (left.s == right.s) & (F.col("hot") < F.col("cold")) & (F.col("c_hot") != F.col("c_cold")) & able & _sizes_allow(F.col("n_hot"), F.col("n_cold")))
    done = tested.select(F.least("hot", "cold").alias("hot"), F.greatest("hot", "cold").alias("cold"))
    return cross.select("hot", "hot_rep", "cold", "cold_rep").distinct().join(done, ["hot", "cold"], "left_anti")
