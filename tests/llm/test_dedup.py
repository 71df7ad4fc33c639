import random

import numpy as np
import pytest
from pyspark.sql import types as T

from genoframe.llm import components, embedding_dedup, minhash, wordarrays as wa
from genoframe.llm.scratch import Scratch
from tests.llm.brute import groups, near_duplicates

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.StringType()), T.StructField("component", T.StringType()), T.StructField("text", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, "clash", "clash", t) for i, t in rows], DOCS)


def mutated(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**9)}" for w in words]


def corpus():
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    texts = []
    for size in (6, 9, 40, 300):
        base = fresh(size)
        texts += [mutated(rng, base, s) for s in [0, 0, 0.01, 0.02, 0.03, 0.05, 0.08] * 4]
    passage = fresh(60)  # many texts share most of their words, and are not near-duplicates
    texts += [passage + fresh(25) for _ in range(60)]
    texts += [fresh(rng.randrange(1, 60)) for _ in range(60)]
    texts = [" ".join(t) for t in texts] + ["", "  \n", "one", "ONE", "one two three four", "a b c d e", "a b c d e f", "a\tb\x0bc d  e", None]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_shingles_are_those_of_the_definition():
    import pyarrow as pa

    for first, _, data, offsets in wa.chunks(pa.array([t for _, t in corpus()])):
        doc, value = wa.shingles(wa.words(data, offsets), 5)
        assert len(set(zip(doc.tolist(), value.tolist(), strict=True))) == len(doc) and (np.diff(doc) >= 0).all()


def test_near_duplicates_are_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()}
    assert got == near_duplicates(rows)


def test_groups_that_break_up_and_hot_shingles(spark):
    rng = random.Random(21)
    fresh = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    # one group of templated texts: six fields of four values, so members link to some others only
    fields = [[fresh(12) for _ in range(4)] for _ in range(6)]
    texts += [sum((rng.choice(f) for f in fields), []) for _ in range(150)]
    # a chain: each text shares most with the next, the ends share nothing
    long = fresh(260)
    texts += [long[k : k + 60] for k in range(0, 200, 4)]
    # one rare-looking shingle run in the prefix of many texts that are no duplicates
    run = fresh(9)
    texts += [run + fresh(14) for _ in range(120)]
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = near_duplicates(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()}
    assert got == want and len({c for _, c, _ in want.values()}) > 130


def test_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, c), (1, a)]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect())
    # both texts of id 1 have links, and all are the document's
    assert got == [(1, 26, 1, True)] * 3 + [(2, 27, 1, False), (3, 27, 1, False), (4, 26, 4, True)]


def test_components_are_extended(spark):
    found = components.connected_components(spark.createDataFrame([(1, 2), (2, 3), (10, 11), (20, 21)], "a long, b long"), Scratch(spark, "t"))
    more = spark.createDataFrame([(3, 11), (30, 31), (31, 21), (1, 3), (5, 5)], "a long, b long")
    got = {r.id: r.component for r in components.extended(found, more, Scratch(spark, "t")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 20: 20, 21: 20, 30: 20, 31: 20}


def test_hard_rows(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (7, "A B C D E F G"), (None, None), (8, None), (9, "x " * 30_000), (10, "x " * 30_001)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()), key=repr)
    assert got == sorted([(5, 3, 5, True), (5, 3, 5, True), (None, 3, 5, True), (7, 3, 5, False), (None, 0, None, True), (8, 0, 8, True), (9, 1, 9, True), (10, 1, 9, False)], key=repr)
    assert minhash.near_duplicates(frame(spark, []), Scratch(spark, "t")).count() == 0


def test_densified_bins_are_borrowed(spark):
    doc, value = np.array([0, 0, 1]), np.array([3, 1 << 63, 7], np.uint64)
    sig = minhash.densified(doc, value, 2)
    assert set(sig[0]) == {3, 1 << 63} and set(sig[1]) == {7}


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, rng.randrange(200, 900)) for _ in range(300)] + [(3, 3), (None, 4), (50, 51), (51, 50)]
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {k: v for k, v in groups([e for e in edges if None not in e and e[0] != e[1]]).items()}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("links", T.StringType())])


def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            base = rng.standard_normal(16)
            rows += [(base + rng.standard_normal(16) * s * 0.2).tolist() + [label] for s in rng.random(25)]
    out = [(i, [float(np.float32(x)) for x in r[:-1]], r[-1], "x") for i, r in enumerate(rows)]
    n = len(out)
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    return out + [(n + k, v, 0, "x") for k, v in enumerate(odd)]


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_links_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    usable = {i: (np.array(v, float), label) for i, v, label, _ in rows if v and None not in v and np.isfinite(v).all() and any(v) and label is not None}
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    links = [(a, b) for a in usable for b in usable if a < b and usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0]) and cos(usable[a][0], usable[b][0]) >= 0.98]
    component, count = groups(links), {}
    for a, b in links:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), Scratch(spark, "t")).collect()}
    assert got == {i: (count.get(i, 0), component.get(i, i), component.get(i, i) == i) for i, *_ in rows} and len(links) > 100


def test_repeated_vectors_and_ids(spark):
    a, b, far = [1.0, 0.0, 0.0], [1.0, 0.05, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, a, 0, "x"), (2, a, 0, "x"), (3, [2.0, 0.0, 0.0], 0, "x"), (4, b, 0, "x"), (5, a, 1, "x"), (6, far, 0, "x"), (6, a, 0, "x"), (6, far, 0, "x"), (7, None, None, "x"), (7, None, 0, "x"), (None, a, 0, "x")]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), Scratch(spark, "t")).where("vec_id IS NOT NULL").collect()))
    # of the vectors of id 6 the one that comes first in order is used
    assert got == [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True)] + [(6, 0, 6, True)] * 3 + [(7, 0, 7, True)] * 2


def test_bits_grow_with_the_table():
    assert [embedding_dedup.plan(n, 0.98)[0] for n in (1, 2**24, 10**9, 10**12)] == [8, 24, 30, 40]
    for n in (10**3, 10**9, 10**12):
        bits, tables = embedding_dedup.plan(n, 0.98)
        assert (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** tables <= 1e-5


def test_wide_codes(spark, monkeypatch):
    rows = vectors()
    want = sorted(tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), Scratch(spark, "t")).collect())
    monkeypatch.setattr(embedding_dedup, "plan", lambda n, threshold: (34, 200))
    assert want == sorted(tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), Scratch(spark, "t")).collect())


def test_no_vectors(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS), Scratch(spark, "t")).count() == 0
