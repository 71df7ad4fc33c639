"""Model predictions from sequence windows; the model is the caller's, no weights come with the library."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.functions import sequence
from genoframe.operators.contigs import with_text


def with_windows(variants: DataFrame, contigs: DataFrame, width: int) -> DataFrame:
    """Adds ``ref_seq, alt_seq`` windows, and ``window_error`` for variants that have none; ``contigs`` are whole or chunked."""
    place = F.col("pos") - 1
    joined = with_text(variants, contigs, "chrom", place - width // 2, place + F.length("ref") + width)
    args = [F.col("_seq"), F.col("pos") - F.col("_offset"), F.col("ref"), F.col("alt")]
    error = F.when(F.col("_seq").isNull(), "INVALID_CHROMOSOME").otherwise(sequence.allele_window_error(*args))
    ref, alt = sequence.allele_windows(*args, width)
    out = joined.withColumn("window_error", error).withColumn("ref_seq", F.when(F.col("window_error").isNull(), ref)).withColumn("alt_seq", F.when(F.col("window_error").isNull(), alt))
    return out.drop("_seq", "_offset")


def predict(windows: DataFrame, load: Callable[[], Callable[[pd.Series], tuple]], batch: int = 256) -> DataFrame:
    """Adds ``ref_logits, ref_logcounts, alt_logits, alt_logcounts``.

    ``load`` runs once in each task and returns a function from a series of at most ``batch`` sequences to (arrays of logits, log counts).
    """
    made = [f for side in ("ref", "alt") for f in (T.StructField(f"{side}_logits", T.ArrayType(T.DoubleType())), T.StructField(f"{side}_logcounts", T.DoubleType()))]
    schema = T.StructType([*windows.schema.fields, *made])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch].copy()
                for side in ("ref", "alt"):
                    logits, counts = model(part[f"{side}_seq"])
                    part[f"{side}_logits"], part[f"{side}_logcounts"] = [list(map(float, x)) for x in logits], [float(x) for x in counts]
                yield part

    return windows.where("window_error IS NULL").mapInPandas(run, schema)


def dinucleotide_shuffle(seq: str, rng: np.random.Generator) -> str:
    """A random text with the same first and last letter and the same count of each pair of letters.

    Letters are the nodes of a graph and pairs its edges. For each letter but the last one a random last edge is drawn until these
    lead to the last letter from everywhere; the other edges are put in random order, and the walk that uses them up is the text.
    """
    if len(seq) < 3:
        return seq
    follow: dict[str, list[str]] = {}
    for a, b in zip(seq, seq[1:]):
        follow.setdefault(a, []).append(b)
    goal = seq[-1]
    while True:
        final = {a: bs[rng.integers(len(bs))] for a, bs in follow.items() if a != goal}
        if all(_leads(a, goal, final) for a in final):
            break
    queue = {}
    for a, bs in follow.items():
        rest = list(bs)
        if a in final:
            rest.remove(final[a])
        rest = [rest[k] for k in rng.permutation(len(rest))]
        queue[a] = iter([*rest, final[a]] if a in final else rest)
    out = [seq[0]]
    for _ in range(len(seq) - 1):
        out.append(next(queue[out[-1]]))
    return "".join(out)


def _leads(a: str, goal: str, final: dict[str, str]) -> bool:
    for _ in range(len(final) + 1):
        if a == goal:
            return True
        a = final.get(a, goal)
    return a == goal


def attribute(windows: DataFrame, load: Callable[[], Callable[[str, list[str]], list[float]]], shuffles: int = 20, seed: int = 0) -> DataFrame:
    """Adds ``ref_attributions, alt_attributions``: a number for each letter of the windows.

    ``load`` runs once in each task and returns a function of a sequence and its ``shuffles`` backgrounds, shuffled so that they
    keep its pairs of letters. Backgrounds depend on the sequence and ``seed`` only, so reruns agree.
    """
    schema = T.StructType([*windows.schema.fields, *[T.StructField(f"{side}_attributions", T.ArrayType(T.DoubleType())) for side in ("ref", "alt")]])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        explain = load()

        def one(seq: str) -> list[float]:
            rng = np.random.default_rng([seed, zlib.crc32(seq.encode())])
            return [float(x) for x in explain(seq, [dinucleotide_shuffle(seq, rng) for _ in range(shuffles)])]

        for frame in frames:
            out = frame.copy()
            for side in ("ref", "alt"):
                out[f"{side}_attributions"] = [one(s) for s in frame[f"{side}_seq"]]
            yield out

    return windows.where("window_error IS NULL").mapInPandas(run, schema)


_LETTER = np.full(256, 4, np.uint8)
for _k, _pair in enumerate((b"Aa", b"Cc", b"Gg", b"Tt")):
    _LETTER[list(_pair)] = _k


def encoded(seqs: list[str]) -> np.ndarray:
    """Sequences of one length as (sequences, positions, ACGT) of 0 and 1; other letters are all zero."""
    letters = np.frombuffer("".join(seqs).encode("ascii", "replace"), np.uint8)
    return np.eye(5, 4, dtype=np.float32)[_LETTER[letters].reshape(len(seqs), -1)]


def hypothetical(multipliers: np.ndarray, backgrounds: np.ndarray) -> np.ndarray:
    """(sequences, positions, ACGT): what each base would contribute, were it at its position, from (sequences, backgrounds, positions,
    ACGT) of multipliers and one-hot backgrounds.

    Putting base i in the background's place changes the input by +1 at i and by -1 at the background's base, each weighed by its
    multiplier: the base's own multiplier less the background's, averaged over the backgrounds.
    """
    wide = multipliers.astype(np.float64)
    return wide.mean(1) - (wide * backgrounds).sum(-1, keepdims=True).mean(1)


def contribute(windows: DataFrame, load: Callable[[], Callable[[np.ndarray, np.ndarray], np.ndarray]], shuffles: int = 20, batch: int = 16, seed: int = 0, shuffle: Callable[[str, np.random.Generator], str] = dinucleotide_shuffle) -> DataFrame:
    """Adds for ``ref`` and ``alt`` ``_hypothetical``, four numbers a letter of the window, and ``_observed``, that of the letter itself (0 if it is
    no base).

    ``load`` runs once in each task and returns a function of one-hot sequences (n, L, 4) and their backgrounds (n, shuffles, L, 4) that gives
    the multipliers, in the backgrounds' shape. At most ``batch`` sequences are held at once. Backgrounds depend on the
    sequence and ``seed`` only, so reruns agree; windows with an error are left out.
    """
    rows = T.ArrayType(T.ArrayType(T.DoubleType()))
    made = [f for side in ("ref", "alt") for f in (T.StructField(f"{side}_hypothetical", rows), T.StructField(f"{side}_observed", T.ArrayType(T.DoubleType())))]
    schema = T.StructType([*windows.schema.fields, *made])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        explain = load()
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch].copy()
                for side in ("ref", "alt"):
                    seqs = list(part[f"{side}_seq"])
                    own = encoded(seqs)
                    others = [shuffle(s, rng) for s in seqs for rng in [np.random.default_rng([seed, zlib.crc32(s.encode())])] for _ in range(shuffles)]
                    backgrounds = encoded(others).reshape(len(seqs), shuffles, *own.shape[1:])
                    found = hypothetical(np.asarray(explain(own, backgrounds)), backgrounds)
                    part[f"{side}_hypothetical"], part[f"{side}_observed"] = [x.tolist() for x in found + 0.0], [x.tolist() for x in (found * own).sum(-1) + 0.0]
                yield part

    return windows.where("window_error IS NULL").mapInPandas(run, schema)
