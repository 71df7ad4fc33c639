"""Collocations by Apriori's level-wise passes.

Pass k counts phrases of k words. A phrase is emitted only where the two phrases of k - 1 words within it are frequent, which
the broadcast bits of the level before tell: a bitmap of hashed phrases whose size has a fixed bound. A bit that two phrases
share lets a rare one be counted in vain and never loses a frequent one; what counts are the exact texts' sums. Each frequent
phrase is then scored at its cuts from the tables of the levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays
from genoframe.llm.scratch import Scratch
from genoframe.llm.workers import tidy

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bits for each frequent phrase, and the most there are: 2^27 bits are 16 MB.
BITS_EACH, MOST_BITS = 64, 1 << 27
#: Bytes of text whose phrases are counted together within a task; phrases of a returned Arrow batch.
GROUP_BYTES, BATCH = 8 << 20, 50_000
#: Parts of a language that are ranked on their own first.
PARTS = 64
#: Languages up to which their totals are broadcast.
FEW_LANGUAGES = 4096
#: Counts have up to 18 digits, a language's words up to 16.
SCORE = "CAST((CAST(a AS decimal(18,0)) * CAST(n AS decimal(16,0)) * 1000BD) DIV (CAST(l AS decimal(18,0)) * CAST(r AS decimal(18,0))) AS bigint)"

_CUT = wordarrays.bytes_in((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
_SPACE = _CUT | wordarrays.bytes_in((0x20, 0x20), (0x09, 0x09))
_BLANK = wordarrays.bytes_in((0x20, 0x20))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEVEL = T.StructType().add("lang", "string").add("phrase", "string").add("f", "long")


def _language(name: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little"))


def _grown(h: np.ndarray, language: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Names of the phrases of 1, 2, ... k words that begin at each word; each is one shorter than the one before."""
    name = wordarrays.mix(h * np.uint64(3) + language)
    yield name
    for j in range(1, k):
        name = wordarrays.mix(name[:-1] * np.uint64(3) + h[j:] + np.uint64(j))
        yield name


def _has(bits: np.ndarray, name: np.ndarray) -> np.ndarray:
    at = name & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """The ``k`` words from each place on, joined by one blank."""
    words = at[:, None] + np.arange(k)
    begins, sizes = starts[words].ravel(), (ends[words] - starts[words] + (np.arange(k) < k - 1)).ravel()
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    out = data[np.minimum(np.arange(total) - np.repeat(stop - sizes, sizes) + np.repeat(begins, sizes), max(len(data) - 1, 0))]
    out[stop.reshape(-1, k)[:, :-1].ravel() - 1] = 32
    offsets = np.concatenate([[0], stop.reshape(-1, k)[:, -1]]).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out)))


def _counted(langs: pa.Array, texts: pa.Array, k: int, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Phrases of ``k`` words of some texts and how often they occur; for single words also all of a language, as a null phrase."""
    names = langs.dictionary_encode()
    codes, listed = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
    salts = np.array([_language(x) for x in listed], np.uint64)
    parts, shift, piece = [], 0, 0
    for first, end, data, offsets in wordarrays.chunks(texts):
        w = wordarrays.words(data, offsets, _SPACE)
        doc = first + np.repeat(np.arange(end - first), np.diff(w.bounds))
        cuts = np.cumsum(_CUT[data])
        # pieces rise with the cuts before a word and with the texts
        run = (cuts[w.starts] if len(w.starts) else np.zeros(0, np.int64)) + doc + piece
        piece += int(cuts[-1]) + 1 if len(cuts) else 1
        parts.append((w.hashes, w.starts + shift, w.ends + shift, run, codes[doc], _LOWER[data]))
        shift += len(data)
    h, starts, ends, run, code, data = (np.concatenate(x) for x in zip(*parts, strict=True))
    if k == 1:
        number = np.bincount(code, minlength=len(listed))
        yield pa.RecordBatch.from_arrays([pa.array(listed, pa.string()), pa.nulls(len(listed), pa.string()), pa.array(number, pa.int64())], _LEVEL.fieldNames())
    if len(h) < k:
        return
    before, name = None, None
    for grown in _grown(h, salts[code], k):
        before, name = name, grown
    sure = run[: len(name)] == run[k - 1 :]
    if k > 1:
        frequent = _has(bits, before)
        sure &= frequent[:-1] & frequent[1:]
    at = np.flatnonzero(sure)
    _, first, count = np.unique(name[at], return_index=True, return_counts=True)
    at = at[first]
    for i in range(0, len(at), BATCH):
        own = at[i : i + BATCH]
        yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(code[own])), _texts(data, starts, ends, own, k), pa.array(count[i : i + BATCH], pa.int64())], _LEVEL.fieldNames())


def _counter(k: int, bits) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            yield from _counted(table.column(0).combine_chunks(), table.column(1).combine_chunks(), k, bits.value if bits else None)

        for batch in batches:
            for row in range(0, batch.num_rows, 256):  # a batch may hold long texts
                some = batch.slice(row, 256)
                if not some.num_rows:
                    continue
                held.append(some)
                size += some.nbytes
                if size >= GROUP_BYTES:
                    yield from done()
                    size = 0
        if held:
            yield from done()

    return run


def _bits(level: DataFrame, k: int) -> np.ndarray | None:
    """The bitmap of a level's frequent phrases, put together by tasks; None if there are none. At most MOST_BITS come to the driver."""
    phrases = level.where("phrase IS NOT NULL")
    n = phrases.count()
    if not n:
        return None
    size = min(1 << max(16, (BITS_EACH * n - 1).bit_length()), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts = {x: _language(x) for x in set(batch.column(0).to_pylist())}
            salt = np.array([salts[x] for x in batch.column(0).to_pylist()], np.uint64)
            for first, end, data, offsets in wordarrays.chunks(batch.column(1)):
                w = wordarrays.words(data, offsets, _BLANK)
                names = list(_grown(w.hashes, np.repeat(salt[first:end], np.diff(w.bounds)), k))[-1]
                at = names[w.bounds[:-1]] & np.uint64(size - 1)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((at & np.uint64(63)).astype(np.int32))], ["place", "bit"])

    told = phrases.select("lang", "phrase").mapInArrow(tidy(run), "place long, bit int").groupBy("place").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[told.column("place").to_numpy()] = told.column("bits").to_numpy()
    return out.view(np.uint64)


def levels(docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> list[DataFrame]:
    """Tables ``lang, phrase, f`` of the phrases of 1, 2, ... words that occur ``least`` times or more in their language; the first also
    has all words of each language, under a null phrase. Fewer tables than ``longest`` if a level is empty."""
    rows = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    out: list[DataFrame] = []
    for k in range(1, longest + 1):
        bits = None
        if k > 1:
            found = _bits(out[-1], k - 1)
            if found is None:
                break
            bits = docs.sparkSession.sparkContext.broadcast(found)
        counted = rows.mapInArrow(tidy(_counter(k, bits)), _LEVEL).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        out.append(scratch.put(counted.where((F.col("f") >= least) | F.col("phrase").isNull()), f"words-{k}"))
    return out


def _part(words: Column, begin: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def mine(docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by score, frequency and text.

    Phrases lie within pieces of a text (parted by ``.,;:!?`` and line ends), occurrences overlap; A-Z count as a-z; a null language is
    ``und``; null texts are empty; repeated rows count each time; texts without words, an empty table and one without a frequent phrase
    give no rows; other columns are not read. A phrase goes if a longer frequent one holds it and occurs as often; as no phrase
    occurs more often than a part of it, that is so for one that is one word longer if for any. Scores are exact: decimals of 38 digits.
    """
    tables = levels(docs, scratch, longest, least, lang_col, text_col)
    spark = docs.sparkSession
    if len(tables) < 2:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    totals = scratch.put(tables[0].where("phrase IS NULL").select("lang", F.col("f").alias("n")), "totals")
    if totals.count() <= FEW_LANGUAGES:
        totals = F.broadcast(totals)
    every, found = tables[0].where("phrase IS NOT NULL"), None
    for k, level in enumerate(tables[1:], 2):
        sized = level.withColumn("k", F.lit(k))
        found = sized if found is None else found.unionByName(sized)
        every = every.unionByName(level)
    w = F.split("phrase", " ")
    inner = found.where("k > 2").select("lang", F.explode(F.array(_part(w, 1, F.col("k") - 1), _part(w, 2, F.col("k") - 1))).alias("phrase"), "f")
    kept = found.join(inner, ["lang", "phrase", "f"], "left_anti")
    cuts = kept.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select("lang", "phrase", F.col("f").alias("a"), "j", _part(w, 1, F.col("j")).alias("left"), _part(w, F.col("j") + 1, F.col("k") - F.col("j")).alias("right"))
    for side in ("left", "right"):
        cuts = cuts.join(every.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])), ["lang", side])
    cuts = cuts.join(totals, "lang")
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr(SCORE).alias("score"), "j", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ahead = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    ahead = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
