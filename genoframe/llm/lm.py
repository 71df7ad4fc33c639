"""N-gram language model of any order in Elias-Fano tries, trained on and applied to whole corpora.

Texts become blocks of local word numbers, written once. Each block sends its distinct words and, order by order, its distinct n-grams
with their training counts to shards; a shard sums the counts of all blocks, and that of n-grams builds a trie of
quantised smoothed probabilities, maps it from a file of its own, looks up every n-gram sent and answers in the order
sent. A word or n-gram may be in every block, so a shard takes its messages one by one: their counts are summed up as they come, the
questions wait in a file of the task's own once they are more than SPOOL bytes, and answers are given in parts; a task holds what is
distinct in its shard, however many blocks ask. A block then has for each of its tokens the exact count of the word and the tries' answers, and sums over its
documents. N-grams are dealt by their context (all words but the last), so a shard has whole contexts; contexts with a large part of
a shard's tokens and more than 1 / HOT of all (fewer than HOT of them) are dealt by the n-gram. Which these are is known beforehand:
a context occurs as often as the shorter n-gram that it is, which the order before has counted. Questions of an order are asked in
up to ROUNDS rounds, each for its own shards, and texts are scored in as many, each for its own blocks, so that only a part of what is
moved lies on the disks at a time. Nothing that grows with the corpus comes to the driver or is broadcast but the counts of these hot contexts, fewer than HOT.

Probabilities: the unigram is discounted by D1 = n1 / (n1 + 2 n2) from word counts, and what is left is the
probability of all unknown words together; with a context h, whose shorter form is h',
p(w | h) = max(c(h w) - D, 0) / c(h) + D t(h) / c(h) p(w | h'), where t(h) is the number of different words after h; a context never
seen leaves p(w | h'). Before a text stand as many end tokens as the order needs. How a context is dealt does not change its
probabilities: shards that share a hot context know its count beforehand, and t(h) is summed over them.
"""

from __future__ import annotations

import itertools
import mmap
import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import wordarrays as wa
from genoframe.llm.eliasfano import HEAD_BITS, TAIL_BITS, NgramTrie, probability
from genoframe.llm.scratch import Scratch
from genoframe.llm.workers import tidy

#: Text of a block, tokens of a shard, about.
BLOCK_BYTES, SHARD_TOKENS = 4 << 20, 1_000_000
#: Contexts with HOT_SHARE of a shard's tokens or more are dealt by pair, if they are among the HOT most frequent ones that a corpus can have.
HOT, HOT_SHARE, DISCOUNT = 1 << 20, 0.25, 0.75
#: An order's questions, and the scoring, take so many rounds at most (pairs half as many), each of so many tokens at least.
ROUNDS, ROUND_TOKENS = 4, 6_000_000
NAME_BITS = HEAD_BITS + TAIL_BITS
#: A shard sums up, and answers, about so many entries of its messages at once; bytes of questions that wait in memory.
PART, SPOOL = 1 << 19, 16 << 20
#: Bytes of freed memory that a worker holds on to within a task: arrays of a block or part are made and dropped all the time.
KEEP = 256 << 20
#: A message counts as so many entries more than it has.
MESSAGE = 16
#: Kinds of messages: counts of a block's words; statistics of words; successors of hot contexts; hot contexts of the next order; and
#: from GRAMS on, by order, codes of a block's n-grams.
WORDS, KNOWN, KINDS, NEXT, GRAMS = 0, 2, 3, 4, 10
#: The end of a text; it is also the context of a text's first word.
END = wa.mix(np.array([0xE0D], np.uint64))[0]
_BLOCK = T.StructType(
    [T.StructField("block", T.LongType()), *[T.StructField(n, T.BinaryType()) for n in ("held", "lengths", "vocabulary", "counts", "tokens")], T.StructField("n_train", T.LongType()), T.StructField("n_tokens", T.LongType())]
)
_MESSAGE = "kind int, shard int, block long, a binary, b binary, c binary, d binary"


def learns(doc_id: str = "doc_id") -> Column:
    """Whether a document may be learned from; ids are compared as text, null ids are not learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 != 2


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers below 2^63 as planes of bytes, as many as the largest needs, which the first byte says."""
    n = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    return bytes([n]) + np.ascontiguousarray(np.ascontiguousarray(x, np.int64).view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    p = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1)
    out = np.zeros((p.shape[1], 8), np.uint8)
    out[:, : b[0]] = p.T
    return out.view(np.int64).ravel()


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of about BLOCK_BYTES of text: ids, lengths and flags of documents; distinct words, most frequent first, with
    their training counts; the local numbers of all tokens."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)), *_BLOCK.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, hashes, counts, size, made = [], [], [], [], 0, 0

        def done() -> pa.RecordBatch:
            nonlocal size, made
            n = np.concatenate(counts)
            ends = np.cumsum(n + 1) - 1
            stream = np.full(int(n.sum()) + len(n), END, np.uint64)
            stream[np.delete(np.arange(len(stream)), ends)] = np.concatenate(hashes)
            out = np.concatenate(held)
            words, local, often = np.unique(stream, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            tokens = place[local]
            train = np.bincount(tokens[np.repeat(~out, n + 1)], minlength=len(words))
            row = [[ids.copy()], [TaskContext.get().partitionId() << 32 | made], [out.astype(np.uint8).tobytes()], [_planes(n + 1)], [words[order].tobytes()], [_planes(train)], [_planes(tokens)], [int(train.sum())], [len(tokens)]]
            for x in (ids, held, hashes, counts):
                x.clear()
            size, made = 0, made + 1
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _arrow(schema), strict=True)], schema.fieldNames())

        for batch in batches:
            for first, end, data, offsets in wa.chunks(batch.column(1)):
                w = wa.words(data, offsets)
                ids += batch.column(0).slice(first, end - first).to_pylist()
                held.append(~batch.column(2).slice(first, end - first).to_numpy(zero_copy_only=False).astype(bool))
                hashes.append(w.hashes)
                counts.append(np.diff(w.bounds))
                size += len(data) + 8 * (end - first)
                if size >= BLOCK_BYTES:
                    yield done()
        if ids:
            yield done()

    return docs.select("doc_id", "text", F.coalesce(learns(), F.lit(False)).alias("learns")).mapInArrow(tidy(run, KEEP), schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["kind", "shard", "block", "a", "b", "c", "d"])


def _split(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order that groups by shard, keeping the order within; [(shard, from, to)])."""
    order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 65536 else shard, kind="stable")
    found = shard[order]
    starts = np.flatnonzero(np.diff(found, prepend=-1))
    return order, [(int(found[a]), int(a), int(b)) for a, b in zip(starts, np.append(starts, len(found))[1:], strict=True)]


def _deal(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _chain(key: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Key of the context that has a word of this name after the context of this key."""
    return wa.mix(key * np.uint64(0x9E3779B97F4A7C15) + name)


def _pairs(major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs of whole numbers below 2^31, in order; the number of each row's pair among them)."""
    if not len(major):
        return major, minor, np.zeros(0, np.int64)
    rows, width = len(major).bit_length(), int(minor.max()).bit_length()
    pair = major << width | minor
    if int(major.max()).bit_length() + width + rows < 64:  # rows fit beside their pairs: numbers are sorted faster than places
        pair = np.sort(pair << rows | np.arange(len(pair)))
        at = pair & ((1 << rows) - 1)
        pair >>= rows
    else:
        at = np.argsort(pair)
        pair = pair[at]
    new = np.ones(len(pair), bool)
    new[1:] = pair[1:] != pair[:-1]
    which = np.empty(len(pair), np.int64)
    which[at] = np.cumsum(new) - 1
    pair = pair[new]
    return pair >> width, pair & ((1 << width) - 1), which


def _among(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which keys are hot; ``hot`` ascends."""
    leading = np.zeros(1 << 16, bool)
    leading[hot >> np.uint64(48)] = True
    out = leading[keys >> np.uint64(48)]
    at = np.flatnonzero(out)
    if len(at):
        out[at] = hot[np.minimum(np.searchsorted(hot, keys[at]), len(hot) - 1)] == keys[at]
    return out


def _contexts(tokens: np.ndarray, vocabulary: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of each token's context of ``order - 1`` words, keys of the contexts). Contexts are in order of their words' local
    numbers; before a text stand end tokens, which have the highest number there, so that the context of its first word comes last."""
    end, start = int(np.flatnonzero(vocabulary == END)[0]), len(vocabulary)
    before = np.concatenate([[start], tokens[:-1]])
    before[before == end] = start
    keys = words = np.append(vocabulary, END)
    number, names = before, _names(words)
    for _ in range(order - 2):
        farther = np.concatenate([number[:1], number[:-1]])
        farther[before == start] = len(keys) - 1
        first, second, number = _pairs(farther, before)
        keys = _chain(keys[first], names[second])
    return number, keys


def _grams(tokens: np.ndarray, vocabulary: np.ndarray, order: int, shards: int, hot: np.ndarray, asked: tuple[int, int] = (0, 1)):
    """Distinct n-grams of a block: (keys of contexts, context and last word, n-gram of each token, order by shard, parts, the tokens, their contexts).

    ``asked``: (k, of), only those whose shard has the remainder k; their order within a shard is the same.
    """
    number, keys = _contexts(tokens, vocabulary, order)
    deal, among = wa.mix(keys * np.uint64(7)), _among(keys, hot)
    shard = _deal(deal, shards)
    own = lambda context, word: _deal(wa.mix(deal[context] + vocabulary[word]), shards)
    k, of = asked
    at = slice(None)
    if of > 1:
        mine = (shard % of == k)[number]
        if among.any():
            heavy = np.flatnonzero(among[number])
            mine[heavy] = own(number[heavy], tokens[heavy]) % of == k
        at = np.flatnonzero(mine)
        number, tokens = number[at], tokens[at]
    first, second, which = _pairs(number, tokens)
    its = shard[first]
    heavy = np.flatnonzero(among[first])
    its[heavy] = own(first[heavy], second[heavy])
    by_shard, parts = _split(its)
    return keys, first, second, which, by_shard, parts, at, number


def _context_runs(context: np.ndarray, parts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(starts and lengths of the runs of one context within a shard), of n-grams in order of shards."""
    new = np.ones(len(context), bool)
    new[1:] = context[1:] != context[:-1]
    new[[a for _, a, _ in parts]] = True
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(context)))


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]]))
    return x[starts], np.diff(np.append(starts, len(x)))


def _names(h: np.ndarray) -> np.ndarray:
    return h >> np.uint64(64 - NAME_BITS)


def _pack_names(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(_names(h).view(np.uint8).reshape(-1, 8)[:, : NAME_BITS // 8]).tobytes()


def _unpack_names(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // (NAME_BITS // 8), 8), np.uint8)
    out[:, : NAME_BITS // 8] = np.frombuffer(b, np.uint8).reshape(-1, NAME_BITS // 8)
    return out.view(np.uint64).ravel()


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: their binary columns are large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _runs_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    held, last = [], None
    for batch in batches:
        for row in _rows(batch):
            key = row["block"]
            if held and key != last:
                yield held
                held = []
            held.append(row)
            last = key
    if held:
        yield held


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[dict]]]:
    """Each shard and its messages, which are in order of shards; they are read as they are taken."""
    return itertools.groupby((row for batch in batches for row in _rows(batch)), key=lambda r: r["shard"])


def _parts(held, size: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    """The questions that wait, in the order in which they came, in parts of about PART entries."""
    held.seek(0)
    part, n = [], 0
    while True:
        try:
            part.append(pickle.load(held))  # noqa: S301 this task's own file
        except EOFError:
            break
        n += size(part[-1]) + MESSAGE
        if n >= PART:
            yield part
            part, n = [], 0
    if part:
        yield part


def _summed_up(entries: Iterator[tuple[np.ndarray, ...]], none: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of their counts; ``entries``: arrays of keys, with those of counts the last. What has come is
    summed up whenever it is as much as what is distinct so far, and PART at least."""
    done, waiting, n = none, [], 0
    for some in entries:
        waiting.append(some)
        n += len(some[-1]) + MESSAGE
        if n >= max(PART, len(done[-1])):
            done, waiting, n = _distinct(*[np.concatenate(x) for x in zip(done, *waiting, strict=True)]), [], 0
    return _distinct(*[np.concatenate(x) for x in zip(done, *waiting, strict=True)])


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    *keys, count = columns
    if _ascends(*keys):
        return *keys, count
    order = _ordered(*keys)
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return *[k[new] for k in keys], np.add.reduceat(count[order], np.flatnonzero(new))


def _ordered(key: np.ndarray, name: np.ndarray | None = None) -> np.ndarray:
    """Rows in order of keys, then of names (below 2^NAME_BITS). Leading bits are sorted with the row beside them, which is faster than to
    sort places; rows that these bits do not tell apart are put in order after."""
    if name is None:
        return np.argsort(key)
    rows = len(key).bit_length()
    here, row = np.uint64(rows), np.arange(len(key), dtype=np.uint64)
    places = lambda by: (by & np.uint64((1 << rows) - 1)).astype(np.int64)
    order = places(np.sort(key >> here << here | row))
    k = key[order]
    rank = np.zeros(len(key), np.uint64)
    np.cumsum(k[1:] != k[:-1], out=rank[1:])
    ranks = int(rank[-1]).bit_length()
    bits = min(NAME_BITS, 64 - rows - ranks)
    if bits < 1 or (k[1:] < k[:-1]).any():  # keys that share their leading bits: hardly ever
        return np.lexsort((name, key))
    by = np.sort((rank << np.uint64(bits) | name[order] >> np.uint64(NAME_BITS - bits)) << here | row)
    order = order[places(by)]
    by >>= here
    n, same = name[order], by[1:] == by[:-1]
    wrong = np.flatnonzero(same & (n[1:] < n[:-1]))
    if len(wrong):
        group = np.concatenate([[0], np.cumsum(~same)])
        tied = np.zeros(int(group[-1]) + 1, bool)
        tied[group[wrong]] = True
        at = np.flatnonzero(tied[group])
        order[at] = order[at][np.lexsort((n[at], group[at]))]
    return order


def _ascends(*keys: np.ndarray) -> bool:
    """Whether rows are distinct and in order already."""
    above = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for k in keys[::-1]:
        above = (k[1:] > k[:-1]) | ((k[1:] == k[:-1]) & above)
    return bool(above.all())


def _added(at: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by place, exact beyond what a double holds."""
    return np.bincount(at, count & 0xFFFFFF, n).astype(np.int64) + (np.bincount(at, count >> 24, n).astype(np.int64) << 24)


def _word_questions(table: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                vocabulary, counts = np.frombuffer(row["vocabulary"], np.uint64), _from_planes(row["counts"])
                order, parts = _split(_deal(vocabulary, shards))
                yield _messages([(WORDS, s, row["block"], vocabulary[order[a:b]].tobytes(), _planes(counts[order[a:b]]), None, None) for s, a, b in parts])

    return table.select("block", "vocabulary", "counts").mapInArrow(tidy(run, KEEP), _MESSAGE)


def _word_sums(rows: Iterator[dict], held) -> tuple[np.ndarray, np.ndarray]:
    """A shard's words, ascending, and their training counts; the questions go to ``held``."""

    def entries() -> Iterator[tuple[np.ndarray, ...]]:
        for r in rows:
            pickle.dump((r["block"], r["a"]), held)
            yield np.frombuffer(r["a"], np.uint64), _from_planes(r["b"])

    return _summed_up(entries(), (np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def _word_answers(questions: DataFrame, most: float) -> DataFrame:
    """WORDS: counts of a block's words; KNOWN: a row of statistics of each task's shards and their heavy words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot, often = np.zeros(3, np.int64), [], []
        for shard, rows in _by_shard(batches):
            with tempfile.SpooledTemporaryFile(SPOOL) as held:
                word, count = _word_sums(rows, held)
                heavy = np.flatnonzero(count > most)
                known += [(count > 0).sum(), (count == 1).sum(), (count == 2).sum()]
                hot.append(word[heavy])
                often.append(count[heavy])
                for part in _parts(held, lambda r: len(r[1]) // 8):
                    yield _messages([(WORDS, shard, block, _planes(count[np.searchsorted(word, np.frombuffer(a, np.uint64))]), None, None, None) for block, a in part])
        if hot:
            yield _messages([(KNOWN, None, None, known.tobytes(), np.concatenate(hot).tobytes(), np.concatenate(often).tobytes(), None)])

    return questions.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(tidy(run, KEEP), _MESSAGE)


def _gram_questions(table: DataFrame, order: int, shards: int, hot: np.ndarray, asked: tuple[int, int] = (0, 1)) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(hot)  # fewer than HOT contexts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                vocabulary, tokens = np.frombuffer(row["vocabulary"], np.uint64), _from_planes(row["tokens"])
                learned = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, _from_planes(row["lengths"]))
                keys, first, second, which, by_shard, parts, at, _ = _grams(tokens, vocabulary, order, shards, shared.value, asked)
                count = np.bincount(which[learned[at]], minlength=len(first))[by_shard]
                context, word = first[by_shard], vocabulary[second[by_shard]]
                starts, lengths = _context_runs(context, parts)
                context = keys[context[starts]]
                for s, a, b in parts:
                    i, j = np.searchsorted(starts, (a, b))
                    yield _messages([(GRAMS + order, s, row["block"], context[i:j].tobytes(), _planes(lengths[i:j]), _pack_names(word[a:b]), _planes(count[a:b]))])

    return table.select("block", "vocabulary", "tokens", "held", "lengths").mapInArrow(tidy(run, KEEP), _MESSAGE)


def shard_trie(context: np.ndarray, name: np.ndarray, count: np.ndarray, hot: np.ndarray, often: np.ndarray, most: float) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the trie of a shard's training n-grams (rows may repeat them), its hot contexts, their different successors here, contexts of
    the next order that occur more than ``most`` times, how often).

    ``hot`` and ``often``: the contexts that are dealt by the n-gram, ascending, and their counts in the whole corpus. No text goes on
    after an end token, so an n-gram that ends in one is no context.
    """
    seen = count > 0
    context, names, c = _distinct(context[seen], name[seen], count[seen])
    contexts, kinds = _runs(context)
    rank = np.repeat(np.arange(len(contexts)), kinds)
    total = _added(rank, c, len(contexts))
    split = _among(contexts, hot)
    total[split] = often[np.searchsorted(hot, contexts[split])]
    left = DISCOUNT * kinds / np.maximum(total, 1)
    heavy = (c > most) & (names != _names(np.array([END]))[0])
    return NgramTrie.build(contexts, kinds, rank, names, (c - DISCOUNT) / total[rank], left), contexts[split], kinds[split], _chain(contexts[rank[heavy]], names[heavy]), c[heavy]


def _gram_sums(rows: Iterator[dict], held) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, last word's name, training count) of a shard's n-grams that training texts have; the questions go to ``held``."""

    def entries() -> Iterator[tuple[np.ndarray, ...]]:
        for r in rows:
            pickle.dump((r["block"], r["a"], r["b"], r["c"]), held)
            count = _from_planes(r["d"])
            seen = count > 0
            yield np.repeat(np.frombuffer(r["a"], np.uint64), _from_planes(r["b"]))[seen], _unpack_names(r["c"])[seen], count[seen]

    return _summed_up(entries(), (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def _gram_answers(questions: DataFrame, order: int, hot: np.ndarray, often: np.ndarray, most: float) -> DataFrame:
    """GRAMS: codes of the probabilities of a block's n-grams, and of the weights left by each run's context; KINDS: how many
    different successors a shard has of its hot contexts; NEXT: hot contexts of the next order and their counts."""
    shared = questions.sparkSession.sparkContext.broadcast((hot, often))  # fewer than HOT contexts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _by_shard(batches):
            with tempfile.SpooledTemporaryFile(SPOOL) as held:
                made, split, kinds, following, times = shard_trie(*_gram_sums(rows, held), *shared.value, most)
                with tempfile.NamedTemporaryFile(delete=False) as f:
                    f.write(made)
                del made
                if len(split):
                    yield _messages([(KINDS, shard, None, split.tobytes(), kinds.astype(np.int64).tobytes(), None, None)])
                if len(following):
                    yield _messages([(NEXT, shard, None, following.tobytes(), times.tobytes(), None, None)])
                with open(f.name, "rb") as g, mmap.mmap(g.fileno(), 0, access=mmap.ACCESS_READ) as levels:
                    os.unlink(f.name)  # the mapping lives on; a killed task leaves nothing behind
                    trie = NgramTrie(levels)
                    for part in _parts(held, lambda r: 8 * len(r[3]) // NAME_BITS):
                        lengths = [_from_planes(n) for _, _, n, _ in part]
                        contexts = np.concatenate([np.frombuffer(a, np.uint64) for _, a, _, _ in part])
                        code, left = trie.lookup(np.repeat(contexts, np.concatenate(lengths)), np.concatenate([_unpack_names(c) for *_, c in part]))
                        at, answers = 0, []
                        for (block, *_), n in zip(part, lengths, strict=True):
                            size = int(n.sum())
                            starts = at + np.cumsum(n) - n
                            answers.append((GRAMS + order, shard, block, code[at : at + size].tobytes(), left[starts].tobytes(), None, None))
                            at += size
                        yield _messages(answers)
                    del trie

    return questions.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(tidy(run, KEEP), _MESSAGE)


def _hot_left(answers: DataFrame, hot: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The weights that hot contexts leave: their different successors, summed over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[k], np.int64)) for k in "ab"], ["word", "kinds"])

    told = answers.where(F.col("kind") == KINDS).select("a", "b").mapInArrow(tidy(run), "word long, kinds long").groupBy("word").agg(F.sum("kinds").alias("kinds")).toArrow()
    out = np.zeros(len(hot))
    place = np.searchsorted(hot, told["word"].to_numpy().view(np.uint64))
    out[place] = DISCOUNT * told["kinds"].to_numpy()
    return out / np.maximum(often, 1)


def _scores(table: DataFrame, answers: DataFrame, shards: int, hots: list[tuple[np.ndarray, np.ndarray]], n: int, v: int, discount: float) -> DataFrame:
    """Scores of all documents; ``hots``: hot contexts and the weights that they leave, order by order from 2 on."""
    out = T.StructType(
        [T.StructField("doc_id", table.schema["ids"].dataType.elementType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    )
    own = table.select("block", F.lit(-1).alias("kind"), F.lit(0).alias("shard"), F.col("vocabulary").alias("a"), F.col("tokens").alias("b"), F.col("held").alias("c"), F.col("lengths").alias("d"), "ids")
    shared = table.sparkSession.sparkContext.broadcast(hots)  # fewer than HOT contexts an order
    both = own.unionByName(answers.select("block", "kind", "shard", "a", "b", "c", "d"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs_of_blocks(batches):
            block = rows[0]
            vocabulary, tokens = np.frombuffer(block["a"], np.uint64), _from_planes(block["b"])
            count = np.zeros(len(vocabulary), np.int64)
            by_shard, parts = _split(_deal(vocabulary, shards))
            told = {(r["kind"], r["shard"]): r for r in rows[1:]}
            for s, a, b in parts:
                count[by_shard[a:b]] = _from_planes(told[WORDS, s]["a"])
            p = (np.where(count > 0, count - discount, discount * v) / max(n, 1) if n else np.ones(len(vocabulary)))[tokens]
            for order, (hot, hot_left) in enumerate(shared.value, 2):
                keys, first, _, which, by_shard, parts, _, number = _grams(tokens, vocabulary, order, shards, hot)
                code, left = np.zeros(len(first), np.uint16), np.zeros(len(keys), np.uint16)
                context = first[by_shard]
                code[by_shard] = np.concatenate([np.frombuffer(told[GRAMS + order, s]["a"], np.uint16) for s, *_ in parts])
                left[context[_context_runs(context, parts)[0]]] = np.concatenate([np.frombuffer(told[GRAMS + order, s]["b"], np.uint16) for s, *_ in parts])
                weight = np.where(left > 0, probability(left), 1.0)  # a context never seen leaves all
                heavy = np.flatnonzero(_among(keys, hot))
                weight[heavy] = hot_left[np.searchsorted(hot, keys[heavy])]  # a shard knows its part of a hot context only
                p = probability(code)[which] + weight[number] * p
            base = np.log10((count + 1) / (n + v + 1))
            lengths = _from_planes(block["d"])
            ends = np.cumsum(lengths)
            total = lambda x: np.add.reduceat(x, ends - lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["ids"], _arrow(out).field(0).type),
                    pa.array(np.frombuffer(block["c"], np.uint8).astype(bool)),
                    pa.array(lengths),
                    pa.array(total((count > 0)[tokens].astype(np.int64))),
                    pa.array(total(base[tokens])),
                    pa.array(total(np.log10(np.maximum(p, 1e-300)))),
                ],
                out.fieldNames(),
            )

    return both.repartition("block").sortWithinPartitions("block", "kind", "shard").mapInArrow(tidy(run, KEEP), out)


def _hot(rows: DataFrame, at: str, times: str, more: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hot contexts, ascending, and their counts: fewer than HOT in all."""
    found = dict(more)
    for r in rows.select(at, times).toLocalIterator():
        found |= dict(zip(np.frombuffer(r[0], np.uint64).tolist(), np.frombuffer(r[1], np.int64).tolist(), strict=True))
    hot = np.array(sorted(found), np.uint64)
    return hot, np.array([found[int(h)] for h in hot], np.int64)


def score(docs: DataFrame, scratch: Scratch, order: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs(doc_id, text)``.

    ``base_score`` is the add-one unigram, ``score`` the log10 probability by the model of n-grams up to ``order`` (2 or more). Null,
    empty and blank texts are one end token. With nothing to learn from every word is unknown and has probability 1. Repeated rows
    are counted and scored each; null ids are scored only. An empty table gives no rows; other columns are not read.
    """
    if order < 2:
        raise ValueError("the order must be 2 at least")
    table = scratch.put(blocks(docs), "blocks", "zstd")
    n, size = table.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    shards = max(8, -(-size // SHARD_TOKENS))
    most = max(n / HOT, HOT_SHARE * SHARD_TOKENS)
    words = scratch.put(_word_answers(_word_questions(table, shards), most), "words", "zstd")
    scratch.release()
    stats = words.where(F.col("kind") == KNOWN)
    known = np.zeros(3, np.int64)
    for r in stats.select("a").toLocalIterator():  # three counts of each task
        known += np.frombuffer(r.a, np.int64)
    v, n1, n2 = known.tolist()
    hot, often = _hot(stats, "b", "c", {})
    ends = dict(zip(hot.tolist(), often.tolist(), strict=True)).get(int(END))
    answers, hots, start = words.where(F.col("kind") == WORDS), [], np.array([END])
    rounds = max(1, min(ROUNDS, size // ROUND_TOKENS))
    for k in range(2, order + 1):
        made, of = [], -(-rounds // 2) if k == 2 else rounds  # pairs come before there are answers of n-grams to lie beside them
        for r in range(of):
            made.append(scratch.put(_gram_answers(_gram_questions(table, k, shards, hot, (r, of)), k, hot, often, most), f"grams{k}", "zstd"))
            scratch.release()
        grams = reduce(DataFrame.unionByName, made)
        answers = answers.unionByName(grams.where(F.col("kind") == GRAMS + k))
        hots.append((hot, _hot_left(grams, hot, often)))
        start = _chain(start, _names(np.array([END])))  # the context of a text's first word comes as often as texts do
        if k < order:
            hot, often = _hot(grams.where(F.col("kind") == NEXT), "a", "b", {int(start[0]): ends} if ends else {})
    discount = n1 / (n1 + 2 * n2) if n1 else 0.5
    scored = []
    for r in range(rounds):
        its = F.pmod(F.xxhash64("block"), F.lit(rounds)) == r
        scored.append(_scores(table.where(its), answers.where(its), shards, hots, n, v, discount))
        if rounds > 1:
            scored[-1] = scratch.put(scored[-1], "scores")
            scratch.release()
    named = reduce(DataFrame.unionByName, scored).withColumn("train_tokens", F.lit(n).cast("long"))
    named = named.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    held = F.coalesce(~learns(), F.lit(False))
    return named.withColumn("held_out", held)
