"""Benchmark passages and collocations against their definitions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from genoframe.llm import decontaminate, phrases
from genoframe.llm.scratch import Scratch
from tests.llm import brute

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("name", T.StringType()), T.StructField("phrase", T.StringType()), T.StructField("f", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, *["clash"] * 4) for i, t, lang in rows], DOCS)


# ---- decontamination


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))


def hits(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        m = min(len(w), 10)
        for k in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[k : k + m])].add(i)
    sizes = {len(x) for x in windows}
    out = []
    for i, t in rows:
        w = words_of(t)
        hit, names = set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                found = windows.get(tuple(w[k : k + m]))
                if found:
                    hit |= set(range(k, k + m))
                    names |= {str(x) for x in found if x is not None}
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def made():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "é", "中", "x1", "the", "of"])
    text = lambda n: rng.choice([" ", ", ", "--", "\n"]).join(word().upper() if rng.random() < 0.2 else word() for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 4, 7, 9, 10, 11, 12, 30])) if k > 2 else "q%d " % k * 12) for k in range(25)]
    items += [(3, "one more row of the same item whose windows count for it too you see"), (4, None), (5, "..."), (None, "a nameless item of exactly ten words that marks words only"), (90, "the same text twice"), (91, "The same, text: twice!"), (92, "left out in the cold of a very long night indeed")]
    long = " ".join(f"w{k}" for k in range(9000))
    items.append((93, long))
    rows = [(k, text(rng.randrange(0, 60))) for k in range(60)]
    whole = [t for _, t in items if t]
    rows += [(100 + k, " ".join([text(5), rng.choice(whole), text(3), rng.choice(whole)])) for k in range(40)]
    rows += [(1, "q0 " * 200), (1, "q0 " * 200), (None, "the same text twice"), (200, None), (201, ""), (202, "?!"), (203, "say the same text; twice said"), (204, "the same textt twice"), (205, "pre " + " ".join(f"W{k}" for k in range(4090, 4115)) + " post"), (206, long), (207, ("z " * 30_000) + "left out in the cold of a very long night indeed"), (208, "left out in the cold of a very long night"), (209, "A NAMELESS item of exactly ten words that marks words only.")]
    return rows, items


@pytest.mark.parametrize("pass_words", [decontaminate.PASS_WORDS, 1500])
def test_occurrences_are_brute_force(spark, pass_words):
    rows, items = made()
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
    found = decontaminate.search(docs_of(spark, [(i, t, "en") for i, t in rows]), table, pass_words=pass_words)
    got = sorted((tuple(r) for r in decontaminate.flags(found).collect()), key=repr)
    assert got == hits(rows, items)
    for r in found.collect():
        assert all(s.end < t.start for s, t in zip(r.spans, r.spans[1:])) and all(s.start < s.end for s in r.spans) and r["items"] == sorted(r["items"])


def test_no_items_and_no_documents(spark):
    rows = docs_of(spark, [(1, "some words", None), (2, None, None)])
    none = spark.createDataFrame([], ITEMS)
    want = hits([(1, "some words"), (2, None)], [])
    assert sorted((tuple(r) for r in decontaminate.flags(decontaminate.search(rows, none)).collect()), key=repr) == want
    assert decontaminate.search(rows.limit(0), spark.createDataFrame([(1, "a b", "x")], ITEMS)).count() == 0


def test_most_places_are_skipped():
    import numpy as np

    from genoframe.llm import wordarrays

    (p,) = decontaminate.patterns([("1", " ".join(f"i{k}" for k in range(40)))])
    data = " ".join(f"d{k}" for k in range(5000)).encode()
    w = wordarrays.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), decontaminate._PARTS)
    assert p.m == 10 and p.shift.max() == 8 and len(decontaminate._stops(w.hashes, p)) < 500


# ---- collocations


def collocations(rows, least, top, longest=5):
    count = defaultdict(Counter)
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        scored = []
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(p, q) for q, b in frequent.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def prose(seed=3, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "new", "york", "city", "é", "中", "a\x00b", "x"]
    fixed = ["new york city hall", "once upon a time", "the the the", "of the"]
    part = lambda: " ".join(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(1, 9)))
    return [(k, rng.choice([". ", ",", "\n", " \t"]).join(part().title() if rng.random() < 0.3 else part() for _ in range(rng.randrange(1, 7))), rng.choice(["en", "en", "fr", None])) for k in range(n)]


@pytest.mark.parametrize("least,top", [(5, 2000), (3, 10), (40, 2000)])
def test_phrases_are_brute_force(spark, least, top):
    rows = prose() + [(7, None, "en"), (7, "", "de"), (8, "...", "de"), (9, "new york city", "en"), (9, "new york city", "en"), (None, "rare words", "xx"), (10, "the " * 9000, "en")]
    got = sorted(tuple(r) for r in phrases.mine(docs_of(spark, rows), Scratch(spark, "t"), least=least, top=top).collect())
    assert got == collocations(rows, least, top)
    assert len(got) > 5


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = prose(4)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 200)
    got = sorted(tuple(r) for r in phrases.mine(docs_of(spark, rows), Scratch(spark, "t"), least=5).collect())
    assert got == collocations(rows, 5, 2000)


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 3 * 10**12
    row = spark.createDataFrame([(big, 4 * 10**15, big + 1, big + 7)], "a long, n long, l long, r long")
    got = row.select(F.expr(phrases.SCORE).alias("s")).first().s
    assert got == 1000 * big * 4 * 10**15 // ((big + 1) * (big + 7))


def test_tables_without_phrases(spark):
    assert phrases.mine(docs_of(spark, []), Scratch(spark, "t")).collect() == []
    assert phrases.mine(docs_of(spark, [(1, None, None), (2, ".,;", "en"), (3, "few words", "en")]), Scratch(spark, "t")).collect() == []
