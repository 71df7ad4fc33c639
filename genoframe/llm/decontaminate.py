"""Benchmark passages in documents, by Wu-Manber multi-pattern search over words.

What is searched for are the windows of ten words of every item (an item of fewer words is one window). Windows of one length
share a shift table: for the block of the last words at a place it tells how far the next window's end is at least, so most
places are never looked at. Where the shift is zero, the block's bucket holds the windows that end in it, the hash of the words
before selects the test strings, and the bytes themselves are compared. All places of a run of text are looked at by many
lanes at once, each with its own stretch of places.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays
from genoframe.llm.workers import tidy

#: Words of a window, and of the block that the shift table knows.
WINDOW, BLOCK = 10, 3
#: Item words that are searched for in one pass over the documents, and so are broadcast at once: about 100 MB of tables at most.
PASS_WORDS = 1 << 21
#: Windows of a slice of an item; a longer item is several slices.
SLICE = 4096
#: Places that one lane looks at.
LANE = 256

_PARTS = wordarrays.bytes_in((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPANS = "array<struct<start:bigint,end:bigint>>"


class Patterns(NamedTuple):
    """All windows of ``m`` words, ordered by bucket and prefix."""

    m: int
    shift: np.ndarray  # by the low bits of a block's hash
    suffixes: np.ndarray  # hash of the last block of each bucket, rising
    keys: np.ndarray  # bucket and prefix of each window, rising
    begins: np.ndarray  # bytes of each window in ``text``
    ends: np.ndarray
    owners: np.ndarray  # number of each window's item in ``names``
    text: bytes
    names: list[str | None]


def _hash(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the ``k`` words from each place on."""
    made = np.zeros(len(at), np.uint64)
    for j in range(k):
        made = wordarrays.mix(made * np.uint64(3) + h[at + j] + np.uint64(k))
    return made


def _key(bucket: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Buckets are fewer than 2^22; what a prefix's other bits would tell apart is left to the comparison."""
    return (bucket.astype(np.uint64) << np.uint64(42)) | (prefix >> np.uint64(22))


def patterns(slices: list[tuple[str | None, str]]) -> list[Patterns]:
    """Tables of all windows of ``slices(name, words joined by one blank)``, one for each length of windows."""
    names = list(dict.fromkeys(name for name, _ in slices))
    number = {name: k for k, name in enumerate(names)}
    texts = [text.encode() for _, text in slices]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    text = b"".join(texts)
    w = wordarrays.words(np.frombuffer(text, np.uint8), offsets, _PARTS)
    counts = np.diff(w.bounds)
    owner = np.repeat(np.array([number[name] for name, _ in slices], np.int64), counts)
    left = np.repeat(w.bounds[1:], counts) - np.arange(len(w.hashes))
    size = np.repeat(np.minimum(counts, WINDOW), counts)
    return [_tables(m, np.flatnonzero((size == m) & (left >= m)), w, owner, text, names) for m in np.unique(size).tolist()]


def _tables(m: int, at: np.ndarray, w: wordarrays.Words, owner: np.ndarray, text: bytes, names: list[str | None]) -> Patterns:
    b = min(BLOCK, m)
    shift = np.full(1 << max(10, int(8 * len(at)).bit_length()), m - b + 1, np.uint8)
    for j in range(m - b + 1):  # later blocks have smaller shifts, which replace larger ones
        shift[_hash(w.hashes, at + j, b) & np.uint64(len(shift) - 1)] = m - b - j
    suffix, prefix = _hash(w.hashes, at + m - b, b), _hash(w.hashes, at, m - b)
    suffixes, bucket = np.unique(suffix, return_inverse=True)
    keys = _key(bucket, prefix)
    order = np.argsort(keys, kind="stable")
    at = at[order]
    return Patterns(m, shift, suffixes, keys[order], w.starts[at], w.ends[at + m - 1], owner[at], text, names)


def _stops(h: np.ndarray, p: Patterns) -> np.ndarray:
    """Places, rising, at which a window may end: those with a zero shift that the lanes come to."""
    b, mask = min(BLOCK, p.m), np.uint64(len(p.shift) - 1)
    at = np.arange(p.m - 1, len(h), LANE)
    end = np.minimum(at + LANE, len(h))
    found = [np.zeros(0, np.int64)]
    while len(at):
        step = p.shift[_hash(h, at - b + 1, b) & mask]
        found.append(at[step == 0])
        at = at + np.maximum(step, 1)
        alive = at < end
        at, end = at[alive], end[alive]
    return np.sort(np.concatenate(found))


def occurrences(w: wordarrays.Words, p: Patterns, known: dict[int, dict[bytes, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text number, first word, numbers of the items) of every occurrence of a window; ``known`` keeps windows read before."""
    b = min(BLOCK, p.m)
    stop = _stops(w.hashes, p)
    doc = np.searchsorted(w.bounds, stop, "right") - 1
    inside = w.bounds[doc] <= stop - p.m + 1
    stop, doc = stop[inside], doc[inside]
    first = stop - p.m + 1
    suffix = _hash(w.hashes, stop - b + 1, b)
    bucket = np.minimum(np.searchsorted(p.suffixes, suffix), max(len(p.suffixes) - 1, 0))
    met = p.suffixes[bucket] == suffix
    first, doc, bucket = first[met], doc[met], bucket[met]
    key = _key(bucket, _hash(w.hashes, first, p.m - b))
    low, high = np.searchsorted(p.keys, key, "left"), np.searchsorted(p.keys, key, "right")
    for k in np.flatnonzero(high > low).tolist():
        strings = known.get(low[k])
        if strings is None:
            strings = {}
            for i in range(low[k], high[k]):
                strings.setdefault(p.text[p.begins[i] : p.ends[i]], []).append(p.owners[i])
            strings = known[low[k]] = {x: np.unique(v) for x, v in strings.items()}
        own = _BETWEEN.sub(b" ", w.data[w.starts[first[k]] : w.ends[first[k] + p.m - 1]].tobytes().lower())
        items = strings.get(own)
        if items is not None:
            yield int(doc[k]), int(first[k]), items


def search_batch(column: pa.Array, tables: list[Patterns], known: list[dict]) -> tuple[np.ndarray, list, list]:
    """(number of words, hit spans, names of the items) of each text."""
    counts, spans, names = [], [], []
    for begin, end, data, offsets in wordarrays.chunks(column):
        w = wordarrays.words(data, offsets, _PARTS)
        edge = np.zeros(len(w.hashes) + 1, np.int64)
        items: list[set] = [set() for _ in range(end - begin)]
        for p, own in zip(tables, known, strict=True):
            for doc, first, found in occurrences(w, p, own):
                edge[first] += 1
                edge[first + p.m] -= 1
                items[doc].update(found.tolist())
        hit = np.cumsum(edge)[:-1] > 0
        for k in range(end - begin):
            a, z = w.bounds[k], w.bounds[k + 1]
            runs = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:z].view(np.int8), [0]]))) if items[k] else np.zeros(0, np.int64)
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(runs[::2], runs[1::2], strict=True)])
            names.append(sorted(x for x in (tables[0].names[i] for i in items[k]) if x is not None) if items[k] else [])
        counts.append(np.diff(w.bounds))
    return np.concatenate(counts) if counts else np.zeros(0, np.int64), spans, names


def _searcher(tables, schema: T.StructType, text_at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[dict] = [{} for _ in tables.value]
        for batch in batches:
            n, spans, names = search_batch(batch.column(text_at), tables.value, known)
            kept = [c for k, c in enumerate(batch.columns) if k != text_at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n.astype(np.int64)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(names, pa.list_(pa.string()))], schema.fieldNames())

    return run


def _slices(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``name, words, n``: the words of every item, cut so that each window is in one slice whole; items without words are none."""
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    listed = items.select(F.col(id_col).cast("string").alias("name"), F.regexp_extract_all(lower, F.lit(_WORD), F.lit(0)).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)), F.lit(SLICE))
    cut = listed.select("name", "w", F.explode(starts).alias("at"))
    part = F.slice("w", F.col("at") + 1, F.lit(SLICE + WINDOW - 1))
    return cut.select("name", F.array_join(part, " ").alias("words"), F.size(part).alias("n"))


def _merged(spans: Column) -> Column:
    """Overlapping and touching spans put together."""
    last = lambda done: F.element_at(done, -1)
    joins = lambda done, x: (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"])
    longer = lambda done, x: F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], x["end"]).alias("end"))))
    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), lambda done, x: F.when(joins(done, x), longer(done, x)).otherwise(F.concat(done, F.array(x))))


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", pass_words: int = PASS_WORDS) -> DataFrame:
    """``id_col, n_words, spans, items`` for each row of ``docs``: its words that lie in an occurrence of an item's window, as merged
    half-open spans of word numbers, and the ids of the items with such a window, as sorted texts.

    Null texts and those without words have nothing; items without words are searched for nowhere; an item without an id marks words but
    is not named; rows that repeat an item's id are one item; repeated documents each give a row; no items or no documents are no
    special case; other columns are not read. Texts are read whole, without a shuffle. Up to ``pass_words`` item words are broadcast; of
    more, parts are searched for in as many passes over the documents, whose findings (not texts) are then brought together by
    id and digest of the text.
    """
    spark = docs.sparkSession
    slices = _slices(items, item_col, item_text)
    passes = math.ceil((slices.agg(F.sum("n")).first()[0] or 0) / pass_words) or 1
    part = F.pmod(F.xxhash64("name", "words"), F.lit(passes))
    found = T.StructType().add("n_words", "long").add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))).add("items", T.ArrayType(T.StringType()))

    def searched(rows: DataFrame, k: int) -> DataFrame:
        # bounded by pass_words
        own = spark.sparkContext.broadcast(patterns([(r.name, r.words) for r in slices.where(part == k).select("name", "words").collect()]))
        schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"] + found.fields)
        return rows.mapInArrow(tidy(_searcher(own, schema, rows.columns.index("_text"))), schema)

    if passes == 1:
        return searched(docs.select(id_col, F.col(text_col).alias("_text")), 0)
    keyed = docs.select(id_col, F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_a"), F.xxhash64(F.lit(1), text_col).alias("_b"))
    key = [id_col, "_a", "_b", "n_words"]
    parts = [searched(keyed, k).groupBy(*key).agg(F.first("spans").alias("spans"), F.first("items").alias("items"), F.count(F.lit(1)).alias("_n")) for k in range(passes)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    both = out.groupBy(*key).agg(_merged(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("_n").alias("_n"))
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(id_col, "n_words", "spans", "items")


def flags(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` of what ``search`` gives."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
