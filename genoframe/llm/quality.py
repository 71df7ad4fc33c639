"""Quality classifier from weak labels: no labelled document is needed.

Overlapping heuristic labellers vote on every document: junk, clean or nothing. Expectation-maximisation over the
counts of vote patterns estimates how often each labeller gives each vote on clean and on junk
documents, and so the posterior of each pattern. A linear scorer over hashed word shapes is then fitted to the posteriors of
a bounded sample of documents, and scores every whole document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays as wa
from genoframe.llm.workers import tidy

#: Documents, about, whose posteriors fit the linear scorer; a hash of doc_id picks them.
SAMPLE_DOCUMENTS = 8000
BUCKETS = 4096
NOTHING, CLEAN, JUNK = 0, 1, 2
LABELLERS = ("symbols", "shouting", "repeats", "separators", "exclamations", "punctuation", "short_words", "vocabulary")
#: Byte classes: 1 upper case, 2 lower case, 3 digit, 4 beyond ASCII, 5 sentence marks, 6 exclamation mark, 7 other signs.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[ord("!")] = 6


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def votes(w: wa.Words) -> np.ndarray:
    """Votes (texts x labellers); a labeller says nothing of texts too short for it, none of a text without words. Those of ASCII
    punctuation and of short words say nothing of texts whose words mostly begin beyond ASCII."""
    n = np.diff(w.bounds)
    some = np.maximum(n, 1)
    share = lambda mask: _sums(mask, w.bounds) / some
    size = w.ends - w.starts
    first, last = (_CLASS[w.data[at]] for at in (w.starts, w.ends - 1))
    second = _CLASS[w.data[np.minimum(w.starts + 1, w.ends - 1)]]
    same = np.zeros(len(size), bool)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    same[w.bounds[:-1][n > 0]] = False
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((w.hashes, owner))
    new = np.ones(len(order), bool)
    new[1:] = (owner[order][1:] != owner[order][:-1]) | (w.hashes[order][1:] != w.hashes[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(n)) / some
    ends = share((last == 5) | (last == 6))
    letters = (first == 1) | (first == 2) | (first == 4)
    named = _sums(letters, w.bounds)
    short = _sums(letters & (size <= 3), w.bounds) / np.maximum(named, 1)
    junk = [
        share((last == 7) & (size > 1)) > 0.15,
        share((first == 1) & (second == 1) & (size > 1)) > 0.3,
        share(same) > 0.15,
        share((first == 7) & (size <= 2)) > 0.2,
        share(last == 6) > 0.2,
        (ends < 0.02) | (ends > 0.4),
        (short < 0.08) | (short > 0.8),
        distinct < 0.12,
    ]
    ascii_ = share(first == 4) <= 0.5
    enough = [n >= 1, n >= 2, n >= 4, n >= 2, n >= 2, (n >= 20) & ascii_, (named >= 20) & ascii_, n >= 50]
    return np.stack([np.where(e, np.where(j, JUNK, CLEAN), NOTHING) for j, e in zip(junk, enough, strict=True)], axis=1).astype(np.int64)


def shapes(w: wa.Words) -> np.ndarray:
    """Hashed shape of each word: classes of its first, second, middle and last two bytes, length, whether it repeats."""
    at = lambda k: _CLASS[w.data[np.clip(k, w.starts, w.ends - 1)]].astype(np.uint64)
    size = w.ends - w.starts
    code = np.searchsorted([2, 4, 7, 11], size, "right").astype(np.uint64)
    for k in (w.starts, w.starts + 1, (w.starts + w.ends) // 2, w.ends - 2, w.ends - 1):
        code = code * np.uint64(8) + at(k)
    same = np.zeros(len(size), np.uint64)
    same[1:] = w.hashes[1:] == w.hashes[:-1]
    same[w.bounds[:-1][np.diff(w.bounds) > 0]] = 0
    return (wa.mix(code * np.uint64(2) + same) % np.uint64(BUCKETS)).astype(np.int64)


def _patterns(docs: DataFrame) -> DataFrame:
    """``pattern, documents``: how many documents have each combination of votes (3^labellers at most)."""
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for _, _, data, offsets in wa.chunks(batch.column(0)):
                for p, c in zip(*np.unique(votes(wa.words(data, offsets)) @ base, return_counts=True), strict=True):
                    total[int(p)] = total.get(int(p), 0) + int(c)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["pattern", "documents"])

    return docs.select("text").mapInArrow(tidy(run), "pattern long, documents long").groupBy("pattern").agg(F.sum("documents").alias("documents"))


def expectation_maximisation(vote: np.ndarray, count: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of junk of each pattern, P(vote | class) as labellers x 2 x 3, share of junk) for patterns of votes.

    Labellers are taken as independent given the class; one that says nothing is left out. It starts from patterns with any vote for junk being junk.
    """
    post = np.where((vote == JUNK).any(1), 0.9, 0.1)
    table, prior = np.zeros((vote.shape[1], 2, 3)), 0.5
    said = vote != NOTHING
    for _ in range(rounds):
        weight = np.stack([(1 - post) * count, post * count])
        prior = (weight[1].sum() + 1) / (count.sum() + 2)
        for v in (CLEAN, JUNK):
            table[:, :, v] = ((vote == v).T @ weight.T + 0.5) / (said.T @ weight.T + 1.0)
        table[:, :, NOTHING] = 1.0
        logs = np.log([1 - prior, prior]) + sum(np.log(table[k][:, vote[:, k]]).T for k in range(vote.shape[1]))
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, table, prior


def _fit_linear(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, target: np.ndarray, rounds: int = 200, step: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression by Adam on the whole sample: weights of the buckets, then the intercept."""
    w, m, s = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    n = max(len(target), 1)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, values * w[cols], n) + w[-1]
        err = (1 / (1 + np.exp(-z)) - target) / n
        g = np.append(np.bincount(cols, values * err[rows], BUCKETS), err.sum()) + decay * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


#: Shares of shapes count as log(1 + 20 share): a text of one word weighs about as much as a long one.
_SCALE = 20.0


def _features(w: wa.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.diff(w.bounds)
    owner = np.repeat(np.arange(len(n)), n)
    cell, count = np.unique(owner * BUCKETS + shapes(w), return_counts=True)
    rows = cell // BUCKETS
    return rows, cell % BUCKETS, np.log1p(count / n[rows] * _SCALE)


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> np.ndarray:
    """Weights of the linear scorer (of junk) from ``docs(doc_id, text)``.

    Vote patterns are counted over all documents; about ``sample_documents`` of them, picked by a hash of doc_id (null
    ids too), come to the driver as shape counts with their pattern. Texts without words are not learned from.
    """
    counted = _patterns(docs).collect()
    if not counted:
        return np.zeros(BUCKETS + 1)
    base = 3 ** np.arange(len(LABELLERS))
    pattern = np.array([r.pattern for r in counted])
    count = np.array([r.documents for r in counted], float)
    post, _, _ = expectation_maximisation(pattern[:, None] // base % 3, count)
    known = dict(zip(pattern.tolist(), post.tolist(), strict=True))
    share = min(1.0, sample_documents / count.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in wa.chunks(batch.column(0)):
                w = wa.words(data, offsets)
                target = [known[p] for p in (votes(w) @ base).tolist()]
                rows, cols, values = _features(w)
                bounds = np.searchsorted(rows, np.arange(len(target) + 1))
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (cols.astype(np.int32), values.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(target, pa.float64())], ["cols", "values", "target"])

    picked = docs.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) < share * 1_000_000).select("text")
    sample = picked.mapInArrow(tidy(run), "cols array<int>, values array<float>, target double").where("size(cols) > 0").toArrow()
    cols, values, target = (sample[c].combine_chunks() for c in ("cols", "values", "target"))
    if not len(target):
        return np.zeros(BUCKETS + 1)
    rows = np.repeat(np.arange(len(target)), np.diff(cols.offsets.to_numpy()))
    return _fit_linear(rows, cols.flatten().to_numpy(), values.flatten().to_numpy().astype(float), target.to_numpy())


def _quality(w: wa.Words, weights: np.ndarray, n: int) -> np.ndarray:
    rows, cols, values = _features(w)
    z = np.bincount(rows, values * weights[cols], n) + weights[-1]
    return np.where(np.diff(w.bounds) > 0, 1 / (1 + np.exp(np.clip(z, -700, 700))), 0.0)


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """``doc_id, quality, kept`` for every row of ``docs(doc_id, text)``; a map without shuffle.

    ``quality`` is 1 minus the scorer's probability of junk; documents of ``threshold`` or more are kept. Null, empty
    and blank texts have quality 0 and are rejected. Repeated rows each give a row; other columns are not read.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wa.chunks(batch.column(1)):
                good = _quality(wa.words(data, offsets), weights, end - first)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(good), pa.array(good >= threshold)], schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def keep(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` of quality ``threshold`` or more, with all their columns; a map without shuffle."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wa.chunks(batch.column(at)):
                good = _quality(wa.words(data, offsets), weights, end - first)
                yield batch.slice(first, end - first).filter(pa.array(good >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
