"""Language identification by unigram pieces, with all segmentations of a word summed.

Words are runs of letters, lower-cased and marked at their start. The pieces are those of a fixed public vocabulary;
each language has a probability for each piece, fitted by expectation-maximisation on a bounded sample of
labelled texts. The probability of a word is the sum over all its segmentations (forward algorithm); a text's is the
product over its words. Whole texts are scored; words met before are looked up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from genoframe.llm.workers import tidy

#: Labelled texts a language, about, from which the piece probabilities are fitted; a hash of doc_id picks them.
SAMPLE_TEXTS = 400
ROUNDS, SMOOTHING = 4, 0.1
#: Bounds of what a worker keeps and handles at once: bytes of remembered word scores, values of a lattice, about, and texts.
MEMO_BYTES, LATTICE_VALUES, BATCH, WORDS = 32 << 20, 500_000, 256, 50_000
#: The vocabulary's mark of a word's start, and the code for texts without letters.
START, UNDETERMINED = "▁", "und"
#: Characters after which a long word's values are scaled, if no piece is as long.
SCALE_STEP = 24


class Pieces(NamedTuple):
    automaton: object
    sizes: np.ndarray  # characters of each piece; the last is the unknown character

    @property
    def longest(self) -> int:
        return int(self.sizes.max())

    @property
    def scale_step(self) -> int:
        return max(SCALE_STEP, self.longest + 1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """Lower-case letter pieces of a sentencepiece model, found by an Aho-Corasick automaton."""
    import ahocorasick
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = sorted({p for i in range(model.get_piece_size()) if (p := model.id_to_piece(i)) == p.lower() and p.lstrip(START).replace("'", "").isalpha() and not p[1:].count(START)} | {START})
    automaton = ahocorasick.Automaton()
    for i, p in enumerate(kept):
        automaton.add_word(p, i)
    automaton.make_automaton()
    return Pieces(automaton, np.array([*map(len, kept), 1]))


@lru_cache(maxsize=1)
def _letters():
    import regex

    return regex.compile(r"\p{L}+").finditer


def words(text: str | None) -> Iterator[str]:
    return (m[0] for m in _letters()(text.lower())) if text else iter(())


class Lattice:
    """All pieces found in a list of words, ordered by their end within the word."""

    def __init__(self, own: Pieces, listed: list[str]):
        joined = "\n".join([START + w for w in listed])
        found = np.fromiter((end << 20 | piece for end, piece in own.automaton.iter(joined)), np.int64)
        length = np.array([len(w) + 1 for w in listed])
        base = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        end, piece = found >> 20, found & (1 << 20) - 1
        single = np.zeros(len(joined), bool)
        single[end[own.sizes[piece] == 1]] = True
        single[base[1:] - 1] = True  # line ends
        unknown = np.flatnonzero(~single)
        end, piece = np.concatenate([end, unknown]), np.concatenate([piece, np.full(len(unknown), len(own.sizes) - 1)])
        word = np.searchsorted(base, end, "right") - 1
        # node k of a word, before its character k, is base + k
        order = np.argsort(end - base[word], kind="stable")
        self.word, self.piece, self.to = word[order], piece[order], end[order] + 1
        self.start = self.to - own.sizes[self.piece]
        self.base, self.length, self.nodes = base, length, len(joined) + 1
        self.longest, self.scale_step = own.longest, own.scale_step
        depth = self.to - base[self.word]
        self.steps = np.searchsorted(depth, np.arange(1, length.max() + 2)) if len(listed) else np.zeros(1, int)

    def forward(self, p: np.ndarray, each: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(values of the nodes, log scale of each word's end, or of each node); long words are scaled on the way."""
        alpha = np.zeros((self.nodes, p.shape[1]))
        alpha[self.base] = 1
        scale = np.zeros((len(self.base), p.shape[1]))
        nodes = np.zeros(alpha.shape) if each else None
        for step in range(1, len(self.steps)):
            s = slice(self.steps[step - 1], self.steps[step])
            gain = alpha[self.start[s]] * p[self.piece[s]]
            order = np.argsort(self.to[s], kind="stable")
            target = self.to[s][order]
            first = np.flatnonzero(np.diff(target, prepend=-1))
            if len(first):
                alpha[target[first]] = np.add.reduceat(gain[order], first, axis=0)
            if step % self.scale_step == 0:
                long = np.flatnonzero(self.length > step)
                recent = self.base[long][:, None] + np.arange(step - self.longest + 1, step + 1)
                most = alpha[recent].max(axis=1)
                most[most == 0] = 1
                alpha[recent] /= most[:, None]
                scale[long] += np.log(most)
                if nodes is not None:  # up to the last node that the next step for scaling may leave as it is
                    ahead = np.minimum(np.arange(step - self.longest + 1, step + self.scale_step + 1), self.length[long][:, None])
                    nodes[self.base[long][:, None] + ahead] = scale[long][:, None]
        return alpha, scale if nodes is None else nodes

    def scores(self, p: np.ndarray) -> np.ndarray:
        alpha, scale = self.forward(p)
        return np.log(np.maximum(alpha[self.base + self.length], 1e-300)) + scale

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece; the backward values of a node have the inverse of its scale."""
        alpha, scale = self.forward(p, True)
        beta = np.zeros_like(alpha)
        beta[self.base + self.length] = counts / np.maximum(alpha[self.base + self.length], 1e-300)
        for step in range(len(self.steps) - 1, 0, -1):
            s = slice(self.steps[step - 1], self.steps[step])
            np.add.at(beta, self.start[s], beta[self.to[s]] * p[self.piece[s]] * np.exp(scale[self.start[s]] - scale[self.to[s]]))
        use = alpha[self.start] * p[self.piece] * beta[self.to] * np.exp(scale[self.start] - scale[self.to])
        return np.column_stack([np.bincount(self.piece, use[:, k], len(p)) for k in range(p.shape[1])])


def _words_at_once(languages: int) -> int:
    """Words of one lattice, so that its values (a dozen nodes a word) stay bounded however many languages there are."""
    return max(100, LATTICE_VALUES // (12 * max(languages, 1)))


def fit(own: Pieces, counted: dict[str, np.ndarray], languages: int) -> np.ndarray:
    """Piece probabilities (pieces x languages) from counts of each word in each language."""
    listed = sorted(counted)
    p = np.full((len(own.sizes), languages), 1.0 / len(own.sizes))
    for _ in range(ROUNDS):
        uses = np.zeros_like(p)
        for at in range(0, len(listed), _words_at_once(languages)):
            some = listed[at : at + _words_at_once(languages)]
            uses += Lattice(own, some).expected(p, np.stack([counted[w] for w in some]))
        uses += SMOOTHING
        p = uses / uses.sum(0)
    return p


def learns(doc_id: str = "doc_id") -> Column:
    """Whether a document may be learned from; ids are compared as text, null ids are not learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2


def train(docs: DataFrame, path: str, sample_texts: int = SAMPLE_TEXTS) -> tuple[list[str], np.ndarray]:
    """(languages in order, piece probabilities) from ``docs(doc_id, text, lang)`` that may be learned from.

    Only word counts of the sample, about ``sample_texts`` a language, come to the driver; languages are those labelled. The
    model, pieces of the vocabulary times languages, is broadcast: 0.25 MB a language for 32,000 pieces.
    """
    usable = docs.where(learns()).where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    sizes = {r.lang: r["count"] for r in usable.select("lang").groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((0, 0))
    share = F.try_element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample_texts / n))]), F.col("lang"))
    picked = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter((lang, w) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in words(text))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(seen.values(), pa.int64())], ["lang", "word", "n"])

    rows = picked.select("lang", "text").mapInArrow(tidy(count), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    place = {lang: k for k, lang in enumerate(languages)}
    counted: dict[str, np.ndarray] = {}
    for lang, word, n in zip(*(c.to_pylist() for c in rows.columns), strict=True):
        counted.setdefault(word, np.zeros(len(languages)))[place[lang]] = n
    return languages, fit(pieces(path), counted, len(languages))


def predict(docs: DataFrame, path: str, languages: list[str], p: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs(doc_id, text)``; a map without shuffle.

    ``score`` is the posterior of the predicted language, all being as likely beforehand. Null texts, texts
    without a letter, and all texts if no language was learned get ``und`` and 0. Ties go to the first language in order.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(p)  # pieces of the fixed vocabulary x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(path, languages, shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                names, sure = scorer(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(sure, pa.float64())], schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def keep(docs: DataFrame, path: str, languages: list[str], p: np.ndarray, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` in a learned language with a score of ``least`` or more, with all their columns."""
    at_text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(path, languages, shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                names, sure = scorer(batch.column(at_text).to_pylist())
                yield batch.filter(pa.array([n != UNDETERMINED and s >= least for n, s in zip(names, sure, strict=True)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


class _Scorer:
    """Languages of lists of texts; words' scores are kept for the next list."""

    def __init__(self, path: str, languages: list[str], p: np.ndarray):
        self.own, self.languages, self.p = pieces(path), languages, p
        self.place: dict[str, int] = {}
        self.most = min(200_000, max(1000, MEMO_BYTES // (8 * max(len(languages), 1))))
        self.scores = np.zeros((self.most, max(len(languages), 1)))

    def _learn(self, texts: list[list[str]]) -> None:
        new = list({w for t in texts for w in t} - self.place.keys())
        if len(self.place) + len(new) > self.most:
            self.place.clear()
            new = list({w for t in texts for w in t})
            if len(new) > len(self.scores):
                self.scores = np.zeros((len(new), len(self.languages)))
        first = len(self.place)
        step = _words_at_once(len(self.languages))
        for k in range(0, len(new), step):
            some = new[k : k + step]
            self.scores[first + k : first + k + len(some)] = Lattice(self.own, some).scores(self.p)
        self.place.update(zip(new, range(first, first + len(new)), strict=True))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Whole texts are scored, some words at a time: a long text is many lists of words, short ones share one."""
        total, some = np.zeros((len(texts), max(len(self.languages), 1))), np.zeros(len(texts), bool)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def done() -> None:
            nonlocal size
            self._learn([w for _, w in held])
            for k, w in held:
                total[k] += self.scores[np.fromiter(map(self.place.__getitem__, w), np.int64, len(w))].sum(0)
                some[k] = True
            held.clear()
            size = 0

        for k, t in enumerate(texts if self.languages else []):
            source = words(t)
            while part := list(islice(source, WORDS)):
                held.append((k, part))
                size += len(part)
                if size >= WORDS:
                    done()
        done()
        best = total.argmax(1)
        sure = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)], np.where(some, sure, 0.0).tolist()
