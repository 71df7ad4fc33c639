import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genoframe.llm import langid, quality, queries

PATH = queries.vocabulary(queries.PIECES)
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])


def test_forward_sums_all_segmentations():
    own = langid.pieces(PATH)
    rng = np.random.default_rng(0)
    p = rng.random((len(own.sizes), 2))
    p /= p.sum(0)
    names = sorted({k for k in own.automaton.keys()})
    place = {name: k for k, name in enumerate(names)}

    def brute(word):
        w = langid.START + word
        best = [np.ones(2)] + [np.zeros(2) for _ in w]
        for end in range(1, len(w) + 1):
            for start in range(end):
                if w[start:end] in place:
                    best[end] = best[end] + best[start] * p[place[w[start:end]]]
            if w[end - 1] not in place:
                best[end] = best[end] + best[end - 1] * p[-1]
        return np.log(best[-1])

    listed = ["the", "a", "thererere", "über", "漢", "q漢x", "zzzzzzz"]
    got = langid.Lattice(own, listed).scores(p)
    assert np.allclose(got, [brute(w) for w in listed])
    long = "there" * 200
    assert np.isfinite(langid.Lattice(own, [long, "a"]).scores(p)).all()
    assert np.allclose(langid.Lattice(own, ["there" * 20]).scores(p), [brute("there" * 20)])


def test_expected_uses_add_up():
    own = langid.pieces(PATH)
    p = np.full((len(own.sizes), 1), 1e-3)
    uses = langid.Lattice(own, ["there", "on"]).expected(p, np.array([[3.0], [2.0]]))
    assert np.isclose((uses[:, 0] * own.sizes).sum(), 3 * 6 + 2 * 3)


def test_expected_uses_of_long_words():
    own = langid.pieces(PATH)
    p = np.random.default_rng(5).random((len(own.sizes), 2))
    p[:, 1] **= 4
    p /= p.sum(0)
    listed = ["there" * n for n in (4, 5, 8, 9, 10, 12)] + ["漢q" * 19, "the"]
    counts = np.arange(1.0, 17).reshape(8, 2)
    whole = langid.Lattice(own, listed)
    got = whole.expected(p, counts)
    # without scaling, as words of this length still need none
    alpha, beta = np.zeros((whole.nodes, 2)), np.zeros((whole.nodes, 2))
    alpha[whole.base] = 1
    for k in range(len(whole.to)):
        alpha[whole.to[k]] += alpha[whole.start[k]] * p[whole.piece[k]]
    beta[whole.base + whole.length] = counts / alpha[whole.base + whole.length]
    for k in reversed(range(len(whole.to))):
        beta[whole.start[k]] += beta[whole.to[k]] * p[whole.piece[k]]
    wanted = np.zeros_like(p)
    np.add.at(wanted, whole.piece, alpha[whole.start] * p[whole.piece] * beta[whole.to])
    assert np.allclose(got, wanted, rtol=1e-9)
    long = langid.Lattice(own, ["there漢" * 900, "on"]).expected(p, np.array([[3.0, 0.0], [2.0, 1.0]]))
    assert np.allclose(own.sizes @ long, [3 * 5401 + 2 * 3, 3])


def test_all_words_are_learned():
    own = langid.pieces(PATH)
    p = langid.fit(own, {"漢" * 30: np.array([400.0, 0.0]), "the" * 12: np.array([0.0, 2.0])}, 2)
    assert p[-1, 0] > 0.2 > 1e-3 > p[-1, 1]


def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = queries.op9_language_id(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.97


def test_many_languages_and_unspaced_scripts(spark):
    rng = np.random.default_rng(9)
    letters = [[chr(0x4E00 + 40 * k + j) for j in range(40)] for k in range(30)]
    text = lambda k: "".join(rng.choice(letters[k], 60)) + "。" + "".join(rng.choice(letters[k], 60))
    rows = [(4 * k + j, text(k), f"l{k:02d}", "") for k in range(30) for j in range(40, 60)]
    docs = spark.createDataFrame(rows, DOCS)
    # none of these characters is a piece, so all languages look alike: the first one, with one chance in 30
    languages, p = langid.train(docs, PATH)
    scorer = langid._Scorer(PATH, languages, p)
    assert len(languages) == 30 and scorer.scores.nbytes <= langid.MEMO_BYTES and langid._words_at_once(10**6) == 100
    names, sure = scorer([text(3), "한국어"])
    assert set(names) <= set(languages) and all(0 < s <= 1 for s in sure)
    rows = [(k, "这是我们的中国人" * 9 if k % 2 else "これはのにをたがでて" * 9, "zh" if k % 2 else "ja", "") for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, PATH, *langid.train(docs, PATH)).collect()}
    assert got == {k: lang for k, _, lang, _ in rows}


def test_language_hard_rows(spark):
    rows = [(1, "the and of it is that " * 5, "en", "x"), (3, "le la les et une des que " * 5, "fr", "x"), (4, None, "en", "x"), (5, "", None, "x"), (6, "123 !! \n", "fr", "x"), (7, "THE and", None, "x"), (7, "THE and", None, "x"), (None, "les des", "fr", "x"), (8, "thereof" * 4000, None, "x"), (9, "漢字", None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    languages, p = langid.train(docs, PATH)
    assert languages == ["en", "fr"]
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(docs, PATH, languages, p).collect()]
    assert sorted(got, key=repr)[:8] == sorted([(1, "en"), (3, "fr"), (4, "und"), (5, "und"), (6, "und"), (7, "en"), (7, "en"), (8, "en")], key=repr) and (None, "fr") in got
    kept = langid.keep(docs, PATH, languages, p)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 3, 7, 8} and not {r.doc_id for r in kept.collect()} & {4, 5, 6}
    none = docs.where("false")
    assert langid.train(none, PATH)[0] == [] and langid.predict(none, PATH, [], np.zeros((0, 0))).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, PATH, [], np.zeros((0, 0))).collect()} == {"und"}


def test_prediction_does_not_read_the_label(spark):
    rows = [(k, "the and of it is" if k % 2 else "le la les et une", "en" if k % 2 else "fr", "") for k in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs, PATH)
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 1000)
    a = [r.lang_pred for r in langid.predict(docs, PATH, *model).orderBy("doc_id").collect()]
    assert a == [r.lang_pred for r in langid.predict(changed, PATH, *model).orderBy("doc_id").collect()]


def test_votes_and_estimates():
    truth = np.random.default_rng(1).random(20_000) < 0.2
    rng = np.random.default_rng(2)
    sens, false = np.array([0.7, 0.6, 0.8, 0.3]), np.array([0.02, 0.05, 0.1, 0.01])
    junk = np.where(truth[:, None], rng.random((20_000, 4)) < sens, rng.random((20_000, 4)) < false)
    vote = np.where(junk, quality.JUNK, quality.CLEAN)
    pattern, place, count = np.unique(vote, axis=0, return_inverse=True, return_counts=True)
    post, table, prior = quality.expectation_maximisation(pattern, count.astype(float))
    assert prior == pytest.approx(0.2, abs=0.03) and np.allclose(table[:, 1, quality.JUNK], sens, atol=0.06) and np.allclose(table[:, 0, quality.JUNK], false, atol=0.03)
    assert ((post[place.ravel()] > 0.5) == truth).mean() > 0.95


def _class(b):
    c = chr(b)
    if b >= 128:
        return 4
    return 1 if "A" <= c <= "Z" else 2 if "a" <= c <= "z" else 3 if "0" <= c <= "9" else 6 if c == "!" else 5 if c in ".,;:?'\"()-" else 7


def _plain_votes(text):
    """Votes by definition, word by word."""
    import re

    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, out = len(w), []
    low = [x.lower() for x in w]
    share = lambda hits: sum(hits) / max(n, 1)
    letters = [x for x in w if _class(x[0]) in (1, 2, 4)]
    short = sum(len(x) <= 3 for x in letters) / max(len(letters), 1)
    ends = share(_class(x[-1]) in (5, 6) for x in w)
    plain = share(_class(x[0]) == 4 for x in w) <= 0.5
    for enough, junk in (
        (n >= 1, share(_class(x[-1]) == 7 and len(x) > 1 for x in w) > 0.15), (n >= 2, share(len(x) > 1 and _class(x[0]) == _class(x[1]) == 1 for x in w) > 0.3), (n >= 4, share(a == b for a, b in zip(low, low[1:])) > 0.15),
        (n >= 2, share(_class(x[0]) == 7 and len(x) <= 2 for x in w) > 0.2), (n >= 2, share(_class(x[-1]) == 6 for x in w) > 0.2), (n >= 20 and plain, ends < 0.02 or ends > 0.4),
        (len(letters) >= 20 and plain, short < 0.08 or short > 0.8), (n >= 50, len(set(low)) / max(n, 1) < 0.12),
    ):
        out.append((quality.JUNK if junk else quality.CLEAN) if enough else quality.NOTHING)
    return out


def _plain_shapes(text):
    """Count of each shape by definition: length class, classes of five bytes, whether the word before is the same."""
    import re
    from collections import Counter

    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    out = Counter()
    for k, x in enumerate(w):
        at = [0, min(1, len(x) - 1), len(x) // 2, max(len(x) - 2, 0), len(x) - 1]
        length = sum(len(x) >= b for b in (2, 4, 7, 11))
        out[(length, *(_class(x[i]) for i in at), k > 0 and w[k - 1].lower() == x.lower())] += 1
    return out


def test_votes_shapes_and_scores_are_their_definition(spark):
    import random

    from genoframe.llm import wordarrays as wa
    import pyarrow as pa

    rng = random.Random(6)
    bits = ["the", "THE", "a", "of", "Über", "漢字", "12", "--", "#", "end.", "go!", "x", "unbelievable", "$$$", "well,", "don't", "The"]
    texts = [" ".join(rng.choices(bits[: rng.randrange(1, len(bits))], k=rng.choice([0, 1, 3, 19, 20, 49, 50, 200]))) for _ in range(300)] + [None, "", " \t", "漢字 漢字 " * 30, "word " * 9000]
    votes, cells, value = [], [], []
    for _, _, data, offsets in wa.chunks(pa.array(texts)):
        w = wa.words(data, offsets)
        votes += quality.votes(w).tolist()
        rows, cols, values = quality._features(w)
        for k in range(len(offsets) - 1):
            cells.append(sorted(cols[rows == k].tolist()))
            value.append(sorted(values[rows == k].tolist()))
    assert votes == [_plain_votes(t) for t in texts]
    assert {v for row in votes for v in row} == {0, 1, 2} and all(len({row[k] for row in votes}) >= 2 for k in range(8))
    # equal shapes share a bucket, and different ones do not but by chance
    found = {}
    for t, own, weights in zip(texts, cells, value, strict=True):
        shapes, n = _plain_shapes(t), sum(_plain_shapes(t).values())
        if len(own) == len(shapes):
            assert weights == pytest.approx(sorted(np.log1p(20 * c / n) for c in shapes.values()))
        if len(shapes) == 1:
            found.setdefault(next(iter(shapes)), set()).update(own)
    assert found and all(len(x) == 1 for x in found.values())
    # the scorer: the logistic of the weighted sum of features
    weights = np.random.default_rng(0).standard_normal(quality.BUCKETS + 1)
    docs = spark.createDataFrame([(k, t, None, None) for k, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in quality.score(docs, weights).collect()}
    for k, (own, t) in enumerate(zip(cells, texts, strict=True)):
        if not own:
            assert got[k].quality == 0 and not got[k].kept
        elif len(own) == 1:
            assert got[k].quality == pytest.approx(1 / (1 + np.exp(weights[own[0]] * np.log1p(20) + weights[-1])))
    # vote patterns are counted over all documents
    base = 3 ** np.arange(8)
    want = {}
    for t in texts:
        p = int(np.dot(_plain_votes(t), base))
        want[p] = want.get(p, 0) + 1
    assert {r.pattern: r.documents for r in quality._patterns(docs).collect()} == want


def test_linear_scorer_reaches_the_least_loss():
    rng = np.random.default_rng(3)
    rows, cols = np.repeat(np.arange(400), 5), rng.integers(0, 30, 2000)
    values, target = rng.random(2000), rng.random(400)
    w = quality._fit_linear(rows, cols, values, target, rounds=3000, step=0.05)
    z = np.bincount(rows, values * w[cols], 400) + w[-1]
    err = (1 / (1 + np.exp(-z)) - target) / 400
    gradient = np.append(np.bincount(cols, values * err[rows], quality.BUCKETS), err.sum()) + 1e-5 * w
    assert np.abs(gradient).max() < 1e-4


def test_quality_against_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = queries.op7_quality(spark, sf_dir).join(labels.select("doc_id", F.col("quality").alias("truth")), "doc_id").toPandas()
    assert (got[got.truth == 1].kept).mean() > 0.97 and (~got[got.truth == 0].kept).mean() > 0.8


def test_quality_hard_rows(spark):
    good = "The cat sat on the mat, and it was good. He said so to us, for that is what we do. " * 3
    rows = [(k, good + str(k), None, None) for k in range(20)] + [(30, "bad bad bad " * 40, None, None), (31, None, None, None), (32, "", None, None), (33, " \n\t", None, None), (1, good, None, None), (None, good, None, None), (34, good * 500, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    w = quality.train(docs)
    got = {(r.doc_id, r.kept) for r in quality.score(docs, w).collect()}
    assert got >= {(30, False), (31, False), (32, False), (33, False), (1, True), (None, True), (34, True)}
    assert quality.keep(docs, w).columns == docs.columns and quality.keep(docs, w).count() == 23
    none = docs.where("false")
    assert quality.score(none, quality.train(none)).count() == 0
