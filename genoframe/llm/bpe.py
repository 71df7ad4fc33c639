"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that can end its encoding. An Aho-Corasick automaton of
the vocabulary gives, at each position, the tokens that are suffixes of the prefix, longest first; the one whose pair
with the last token of the remaining prefix is compatible is stored. Following these back-pointers from the
end gives exactly the ids that merging in rank order gives, in time linear in the text.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from genoframe.llm.workers import tidy

#: Fixed value: how byte-level vocabularies split text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bounds of the memory that a worker keeps; beyond them it forgets and computes anew.
MEMO_ENTRIES, MEMO_LENGTH, PAIR_ENTRIES = 200_000, 48, 300_000
#: Smaller bounds, of (memo, pairs), for jobs whose workers share an executor's memory with much else; they take more time.
SMALL = (50_000, 100_000)
#: Documents in a returned Arrow batch.
BATCH = 256
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Printable characters that stand for bytes in the vocabulary file: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Encodes and decodes with a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str, bounds: tuple[int, int] = (MEMO_ENTRIES, PAIR_ENTRIES)):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        for t in spec["added_tokens"]:
            if any(t.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"added token {t['content']!r}: only tokens that are found as they stand are supported")
        if spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("add_prefix_space"):
            raise ValueError("only vocabularies without a normalizer and a prefix space are supported")
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: raw(t) for t, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            pair = vocab[a], vocab[b]
            self.rank.setdefault(pair, r)
            parts.setdefault(vocab[a + b], (*pair, r))
        self.parts = parts
        self.automaton = ahocorasick.Automaton()
        for i, b in self.bytes_of.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.find_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.find_pieces = regex.compile(PIECES).findall
        self.left, self.right, self.compatible_pairs = {}, {}, {}
        memo_entries, self.pair_entries = bounds
        self.memo = _Memo(self, memo_entries)

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Constituents at one edge of a token, with the rank of the merge that uses each up."""
        out, end = [], NEVER
        while True:
            out.append((token, end))
            if token not in self.parts:
                return out
            *sides, end = self.parts[token]
            token = sides[side]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` followed by those of ``b`` ends with exactly these two tokens.

        It does unless some merge across the border comes while both its sides exist. Merges of one rank
        run from left to right: at equal rank the left side is already used up, the right side is not.
        """
        known = self.compatible_pairs.get((a, b))
        if known is None:
            if len(self.compatible_pairs) >= self.pair_entries:
                self.compatible_pairs.clear()
            right = self.right.get(a) or self.right.setdefault(a, self._spine(a, 1))
            left = self.left.get(b) or self.left.setdefault(b, self._spine(b, 0))
            rank = self.rank.get
            known = not any((r := rank((x, y))) is not None and r < x_end and r <= y_end for x, x_end in right for y, y_end in left)
            self.compatible_pairs[a, b] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        data = piece.encode("utf-8").decode("latin-1")
        n = len(data)
        last, sizes = [-1] * n, [0] * n  # of the prefix that ends with each place
        known, compatible = self.compatible_pairs.get, self.compatible
        for end, (token, size) in self.automaton.iter(data):
            if last[end] < 0:
                start = end - size
                if start >= 0:
                    before = last[start]
                    ok = known((before, token))
                    if not (compatible(before, token) if ok is None else ok):
                        continue
                last[end], sizes[end] = token, size
        ids, at = [], n - 1
        while at >= 0:
            ids.append(last[at])
            at -= sizes[at]
        ids.reverse()
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers; special tokens' strings become their ids."""
        known = self.memo.__getitem__
        if not self.find_special or not self.find_special.search(text):
            return b"".join(map(known, self.find_pieces(text)))
        out, at = [], 0
        for m in self.find_special.finditer(text):
            out += [*map(known, self.find_pieces(text[at : m.start()])), np.int32(self.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, *map(known, self.find_pieces(text[at:]))])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text or ""), "<i4").tolist()

    def decode(self, ids) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Memo(dict):
    """Ids of pieces met before, as bytes. Of two generations the older one is forgotten when the newer is full."""

    def __init__(self, encoder: PrefixEncoder, entries: int):
        super().__init__()
        self.encoder, self.older, self.entries = encoder, {}, entries

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.encoder.encode_piece(piece)).tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=1)
def encoder(path: str, bounds: tuple[int, int] = (MEMO_ENTRIES, PAIR_ENTRIES)) -> PrefixEncoder:
    return PrefixEncoder(path, bounds)


def _strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", bounds: tuple[int, int] = (MEMO_ENTRIES, PAIR_ENTRIES)) -> DataFrame:
    """``id_col, ids array<int>`` for every row, in no order.

    ``vocabulary`` is the path of the vocabulary file on every executor. Whole texts are encoded, null as empty; empty
    texts give an empty array; repeated rows each give a row; other columns are not read. A map without shuffle.
    ``bounds``: pieces and pairs of tokens that a worker keeps; results do not depend on them.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_bytes = encoder(vocabulary, bounds).encode_bytes
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                coded = [encode_bytes(x) for x in _strings(batch.column(1))]
                offsets = np.zeros(len(coded) + 1, np.int64)
                np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), schema)


def decode(coded: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, keeping ``id_col`` and ``ids``; null ids give the empty text."""
    schema = T.StructType([coded.schema[id_col], coded.schema["ids"], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary)
        size = max(e.bytes_of) + 1
        table = np.array([e.bytes_of.get(i, b"") for i in range(size)], object)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                column = batch.column(1)
                offsets, ids = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                texts = [b"".join(table[ids[a:b]]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(texts, pa.string())], [id_col, "ids", "decoded"])

    return coded.select(id_col, "ids").mapInArrow(tidy(run), schema)
