import gzip
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from genoframe.llm import eliasfano, hilbert, html, lm, mixing, queries, warc
from genoframe.llm.scratch import Scratch
from tests.llm import brute

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("text", T.StringType()), T.StructField("size", T.StringType()), T.StructField("target", T.StringType())])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, wanted = queries.QUERIES[name](spark, sf_dir), c.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    plain = lambda rows: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert plain(got.select(*columns).collect()) == plain(wanted.project(", ".join(f'"{x}"' for x in columns)).fetchall())


# ---- mixing


def mixed(spark, rows):
    return mixing.mix(spark.createDataFrame([(i, s, t, "clash", "clash") for i, s, t in rows], DOCS))


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 1, "é": 900, "z": 90, "zz": 4000, None: 7}, {None: 50}])
def test_mix_meets_its_targets(spark, sizes):
    rows, k = [], 0
    for s, n in sizes.items():
        while n:
            take = min(n, 1 + k % 9)
            rows.append((k, s, " ".join(["w"] * take)))
            n, k = n - take, k + 1
    got = mixed(spark, rows).collect()
    wanted = brute.targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(wanted[s]) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - wanted[s]) <= 9 and all(r.taken in (0, r.size, 2 * r.size) for r in own)


def test_mix_hard_rows(spark):
    got = {(r.doc_id, r.source, r["size"]) for r in mixed(spark, [(1, "a", None), (2, None, ""), (3, "a", " \t\n\x0b"), (4, "b", "x\x0by\xa0z w"), (4, "b", "x\x0by\xa0z w"), (None, "b", "q")]).collect()}
    assert got == {(1, "a", 0), (2, None, 0), (3, "a", 0), (4, "b", 3), (None, "b", 1)}
    assert mixed(spark, []).count() == 0
    assert [r.target for r in mixed(spark, [(1, "a", ""), (2, "b", None)]).collect()] == [0.0, 0.0]


def test_the_schedules_demand_decides_what_is_taken(spark):
    rows = [(k, "a", "w " * (1 + k % 5)) for k in range(300)]
    docs = spark.createDataFrame([(i, s, t, "clash", "clash") for i, s, t in rows], DOCS)
    for schedule in ([(1.0, 1.0)], [(0.5, 0.0), (0.5, 3.0)], [(0.25, 1.0), (0.5, 0.0), (0.25, 1.0)]):
        got = mixing.mix(docs, schedules=(schedule,)).collect()
        for r in got:
            want = []
            for p in range(2):
                used = (p * r.source_size + r.start + r.size / 2) / r.target
                if used < 1:  # the time at which the weights' integral reaches the share, by walking the steps
                    left, time = used * sum(dt * w for dt, w in schedule), 0.0
                    for dt, w in schedule:
                        if left < dt * w:
                            time += left / w
                            break
                        left, time = left - dt * w, time + dt
                    want.append(time)
            assert r.positions == pytest.approx(want) and r.passes == len(want) and r.taken == r.size * len(want)
    placed = mixing.by_first_position(mixing.mix(docs)).select("position", "doc_id").collect()
    assert [tuple(r) for r in placed] == sorted((tuple(r) for r in placed), key=lambda x: (x[0] is not None, x)) and len(placed) == 300


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from genoframe.llm import scratch

    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        conf = Conf
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError):
        scratch.shared_folder(Session)


def test_curriculum_follows_the_schedules(spark):
    rows = [(k, "ab"[k % 2], "w w w") for k in range(2000)]
    placed = mixing.curriculum(mixed(spark, rows))
    got = placed.select("source", "position", "size", "doc_id", "pass").collect()
    assert [(r.position, r.doc_id, r["pass"]) for r in got] == sorted((r.position, r.doc_id, r["pass"]) for r in got)
    for source, weights in (("a", (4, 3, 2, 1)), ("b", (1, 2, 3, 4))):
        quarter = Counter(min(int(r.position * 4), 3) for r in got if r.source == source)
        n = sum(quarter.values())
        assert all(abs(quarter[k] / n - w / 10) < 0.01 for k, w in enumerate(weights))
    again = [tuple(r) for r in mixing.curriculum(mixed(spark, rows)).select("doc_id", "pass", "position").collect()]
    assert again == [(r.doc_id, r["pass"], r.position) for r in got]


# ---- html


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a &amp; b&nbsp;c &#65;&copy</p>", "a & b c A©"), ("<p>one<br>two <b>bo</b>ld", "one two bold"),
        ("<nav>menu</nav><article><h1>T</h1><p>One.</p><p></p><p>Two</p></article><footer>f</footer>", "T\nOne.\nTwo"),
        ("<body><div class='sidebar'><p>Long long text, with much, much punctuation. Really.</div><div id=content><p>Body text of the page, yes.<p>And more of it.</div>", "Body text of the page, yes.\nAnd more of it."),
        ("<article><p>A<div class='comments'><p>Nice!</div><form><p>mail</form><aside>x</aside><script>var a='<p>';</script><p>B</article>", "A\nB"),
        ("<article><p>Cut off <b>her", "Cut off her"), ("<article><p>x<!-- never closed", "x"), ("<script>never closed", ""), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<div class=cookie-notice>We use cookies, ok.</div><main><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main>", "a\nb\nc\nd"), ("<div></div>", ""), ("<p hidden>x</p><p style='display: none'>y</p><p>z</p>", "z"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "with-comments", "page navbar-fixed", "content-widget", "search-result", "sidebar", "page menu"])
def test_a_name_does_not_cost_the_article(name):
    for key in ("class", "id"):
        assert html.main_text(f"<div {key}='{name}'><nav>n</nav><article><p>One.</p></article></div><div class='ad'>Buy, now!</div>") == "One."
    body = "<p>Long text of the page, with marks, and more. And then some.</p>" * 3
    assert html.main_text(f"<body><div class='{name}'>{body}</div><div class=cookie-bar>Yes.</div>").count("marks") == 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div data-id='comments'><p>One.</p></div>", "One."), ("<div title='hidden gems'><p>One.</p></div>", "One."), ("<p data-state='hidden'>One.</p>", "One."), ("<p data-x=hidden data-role='navigation'>One.</p>", "One."),
        ("<p>Two.</p><p class=x HIDDEN>x</p><p title='a > b' hidden=''>x</p>", "Two."),
        ("<article><p>One.</p></article><div class='related-posts'><article><p>Two.</p></article></div><div class='sidebar-left'><p>x</p></div>", "One."),
        ("<article><p>One.</p><section id=comments>" + "<article class='comment odd'><p>Well, well, well. Yes.</p></article>" * 40 + "</section></article>", "One."),
        ("<div class=elementor-widget><p>One, two.</p></div><div class=elementor-widget><p>Three, four.</p></div>", "One, two.\nThree, four."),
        ("<div class=ad>Buy.</div><div class='site-footer'><a href=x>all of it</a></div>", ""),
    ],
)
def test_names_and_attributes(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("n", [3, 300])
def test_short_parts_of_long_pages_stay(n):
    long = "<p>A long paragraph, with marks; and with more of them, too: yes.</p>" * n
    text = "\n".join(["A long paragraph, with marks; and with more of them, too: yes."] * n)
    short = "<h2>Notes</h2><p>One short paragraph</p>"
    for page in (f"<div id=content>{long}<section id=notes>{short}</section></div>", f"<body><div id=content>{long}</div><section id=notes>{short}</section></body>", f"<article>{long}</article><article>{short}</article>"):
        assert html.main_text(page) == text + "\nNotes\nOne short paragraph"
    assert html.main_text(f"<body><div class=intro><p>In short, it is so.</p></div><div class=wrap><div class=text>{long}</div></div></body>") == f"In short, it is so.\n{text}"
    parts = f"<div class=intro><p>Read on</p></div><div class=body>{long}</div><div class=end><p>The end</p></div><div class=list><a href=x>all links here</a></div>"
    for page in (parts, f"<body>{parts}</body>", f"<body><div class=page>{parts}</div></body>"):
        assert html.main_text(page) == f"Read on\n{text}\nThe end"


def test_long_pages_are_linear():
    assert len(html.main_text("<article>" + "<p>word, word." * 50_000)) == 50_000 * 12 - 1
    assert html.main_text("<" * 20_000).count("<") == 20_000
    assert html.main_text("<div>" * 3_000 + "deep" + "</div>" * 3_000) == "deep"


_MARKUP = ["<div>x", "<div></p>", "<i><div></i>", "<ul><li>x", "<div><b>x<p>y", "<div class=ad><div>x", "<table><tr><td>", "<a '\">x", "<a", "a", "<a 'x>", "<a \"x>", "<a b=\"", "<a b = ", "<!-", "<!--", "<", "</", "&am", "<p title='a>b' "]


@pytest.mark.parametrize("part", _MARKUP)
@pytest.mark.parametrize("begin,end", [("", ""), ("<p>hello</p><", ""), ("", '"'), ("<b>", "'>")])
def test_broken_and_nested_markup_is_read_in_linear_time(part, begin, end):
    """Ten times the text takes about ten times the time; quadratic reading would take a hundred times."""
    import time

    def took(n):
        page = begin + part * n + end
        times = []
        for _ in range(2):
            at = time.process_time()
            html.main_text(page)
            times.append(time.process_time() - at)
        return min(times)

    n = 40_000 // len(part)
    assert took(10 * n) < 40 * max(took(n), 0.005)


def test_cut_off_tags_end_the_page():
    assert html.main_text("<p>hello</p><" + "a" * 1_000_000) == "hello"
    assert html.main_text("<p>hello</p>" + "<a" * 500_000) == "hello"
    assert html.main_text("<p>one</p><a href='x>two</a><p>three</p>") == "one\ntwo\nthree"


def test_character_references_end_with_their_part():
    assert html.main_text("<p>&am<b>p;</b> &lt;b&gt; &amp;amp; &#233;&eacute &nbsp; x</p>") == "&amp; <b> &amp; éé x"


LONG = "<h1>Title</h1>" + "<p>A long paragraph, with marks; and with more of them, too: yes.</p>" * 8
LONG_TEXT = "\n".join(["Title"] + ["A long paragraph, with marks; and with more of them, too: yes."] * 8)
NOTES = "<div class=usernotes><h3>2 notes</h3>" + "".join(f"<div class=note><b>{who}</b><p>{what}</p></div>" for who, what in (("bob", "I liked it, thanks."), ("al on 3 May", "Me too, really. It is long, and has marks; yes."))) + "</div>"
LINKS = "<div class='site-links'>(c) Example Ltd, <a href=a>About the site</a> | <a href=b>Help</a></div>"


@pytest.mark.parametrize("wrap", ["<body><div class=content>{}</div>{}</body>", "<body><div id=page><div class=text>{}</div>{}</div></body>", "<body><article>{}</article>{}</body>", "<body><main>{}</main>{}</body>"])
@pytest.mark.parametrize("rest", [NOTES, LINKS, NOTES + LINKS])
def test_comments_and_link_lists_are_told_by_their_shape(wrap, rest):
    assert html.main_text(wrap.format(LONG, rest)) == LONG_TEXT


def test_footnotes_and_sections_are_not_comments():
    notes = "<div class=notes><div class=note><p>1. See the book, page 7.</p></div><div class=note><p>2. See another book.</p></div></div>"
    assert html.main_text(f"<body><div class=content>{LONG}</div>{notes}</body>") == LONG_TEXT + "\n1. See the book, page 7.\n2. See another book."
    sections = "".join(f"<section><h2>Part {k}</h2><p>Some text of the part, as it is.</p></section>" for k in range(3))
    assert html.main_text(f"<body><div class=content>{LONG}{sections}</div></body>").count("Some text of the part, as it is.") == 3


@pytest.mark.parametrize("teaser", ["<article class=card><a href=x><h3>Other story</h3></a></article>" * 2, "<article><a href=x>Another story of today</a><p>Short.</p></article>"])
def test_teaser_articles_go(teaser):
    for page in (f"<body><article>{LONG}</article>{teaser}</body>", f"<body><main><article>{LONG}</article></main>{teaser}</body>", f"<body><main>{LONG}</main><div>{teaser}</div></body>"):
        assert html.main_text(page) == LONG_TEXT


def test_names_inside_an_article_are_no_reason_to_cut_it():
    page = "<article class='search-results'><p>One.</p><div id='related-work'><p>Two.</p></div><div class='notice-of-intent'><p>Three.</p></div></article>"
    assert html.main_text(page) == "One.\nTwo.\nThree."


def test_pages_frame(spark, sf_dir):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])
    rows = [(1, "u", "<p>é</p>", "clash"), (1, "u", "<p>é</p>", "clash"), (None, None, None, None)]
    got = sorted((tuple(r) for r in html.extract(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)], key=repr)
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
    import re

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").join(queries.op1_html(spark, sf_dir).select("page_id", "text"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        import html as entities

        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("<(?:p|h1|br)>", article)]
        assert r.text == "\n".join(p for p in parts if p)


# ---- nearest neighbours


def test_hilbert_curve_is_continuous():
    for d, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())])


def test_recall_and_order(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = queries.op5_hilbert_ann(spark, sf_dir).toPandas()
    hit = 0
    for i in np.flatnonzero(ids % 20 == 0):
        own = got[got.query_id == ids[i]].sort_values("rank")
        s = x @ x[i]
        s[i] = -np.inf
        assert list(own["rank"]) == list(range(1, 21)) and ids[i] not in set(own.vec_id)
        assert np.allclose(own.score, s[np.searchsorted(ids, own.vec_id)], atol=1e-12) and list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
        hit += len(set(own.vec_id) & set(ids[np.lexsort((ids, -s))[:20]]))
    assert hit / 20 / (ids % 20 == 0).sum() >= 0.9


def test_few_and_odd_vectors(spark):
    good = [(0, [1.0, 0.0], "x"), (20, [1.0, 0.0], "x"), (3, [2.0, 1.0], "x"), (2, [2.0, 5.0], "x"), (2, [2.0, 5.0], "x")]
    odd = [(40, None, "x"), (60, [0.0, 0.0], "x"), (5, [float("nan"), 1.0], "x"), (6, [None, 1.0], "x"), (7, [float("inf"), 1.0], "x"), (8, [], "x"), (None, [1.0, 1.0], "x"), (80, [1.0, 1.0, 1.0], "x")]
    got = [tuple(r) for r in hilbert.nearest(spark.createDataFrame(good + odd, VECTORS), F.col("vec_id") % 20 == 0, Scratch(spark, "t"), 20).orderBy("query_id", "rank").select("query_id", "rank", "vec_id", "score").collect()]
    assert got == [(0, 1, 2, 2.0), (0, 2, 3, 2.0), (0, 3, 20, 1.0), (20, 1, 2, 2.0), (20, 2, 3, 2.0), (20, 3, 0, 1.0)]
    assert hilbert.nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0, Scratch(spark, "t")).count() == 0


def test_repeated_ids_and_many_blocks(spark, monkeypatch):
    for name, size in (("ROW_BLOCK", 8), ("QUERY_BLOCK", 4), ("QUERY_STEP", 3)):
        monkeypatch.setattr(hilbert, name, size)
    rng = np.random.default_rng(8)
    x = rng.integers(-9, 9, (600, 4)).astype(float)
    x[(x == 0).all(1)] = 1
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)] + [(i, [99.0] * 4, "x") for i in range(0, 600, 7)]
    got = hilbert.nearest(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, Scratch(spark, "t"), 5, slices=4, reach=3)
    best = {}
    for r in got.collect():
        best.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i in range(0, 600, 20):
        s = x @ x[i]
        s[i] = -np.inf
        near = np.lexsort((np.arange(600), -s))[:5]
        assert sorted(best[i]) == [(k + 1, int(j), s[j]) for k, j in enumerate(near)]


# ---- language model


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((0, 9), (1, 0), (1, 2**64 - 1), (500, 50), (500, 2**63), (5000, 2**40)):
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        e = eliasfano.EliasFano(eliasfano.EliasFano.encode(v))
        assert (e.get(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, top, 300, dtype=np.uint64, endpoint=True), np.array([0, 2**64 - 1], np.uint64)])
        place, found = e.successor(q)
        assert (place == np.searchsorted(v, q)).all() and (found == np.isin(q, v)).all()


@pytest.mark.parametrize(("block", "order"), [(4 << 20, 2), (300, 2), (300, 3), (4 << 20, 4)])
def test_model_is_its_definition(spark, monkeypatch, block, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm, "HOT", 64)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 400)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"{'Ww'[k % 2]}{min(int(x), 40)}" for k, x in enumerate(rng.zipf(1.3, rng.integers(0, 60)))) for _ in range(200)] + ["w1 w2 w1"] * 150 + [None, "", " \n", "never seen words"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("score", T.StringType())])
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], schema), Scratch(spark, "t"), order).collect()}
    tokens = [[*brute.words(t), "</s>"] for t in texts]
    train = [zlib.crc32(str(k).encode()) % 7 != 2 for k in range(len(texts))]
    c = Counter(w for t, ok in zip(tokens, train) if ok for w in t)

    def grams(t, k):  # as many ends as the order needs stand before a text
        padded = ["</s>"] * (k - 1) + t
        return [tuple(padded[j : j + k]) for j in range(len(t))]

    times = {k: Counter(g for t, ok in zip(tokens, train) if ok for g in grams(t, k)) for k in range(2, order + 1)}
    context = {k: Counter() for k in times}
    for k, many in times.items():
        for g, m in many.items():
            context[k][g[:-1]] += m
    kinds = {k: Counter(g[:-1] for g in many) for k, many in times.items()}
    n, v = sum(c.values()), len(c)
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 else 0.5

    def p(g):
        k = len(g)
        if k == 1:
            return (c[g[0]] - d) / n if c[g[0]] else d * v / n
        low, seen = p(g[1:]), context[k][g[:-1]]
        return max(times[k][g] - 0.75, 0) / seen + 0.75 * kinds[k][g[:-1]] / seen * low if seen else low

    for k, t in enumerate(tokens):
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(c[w] > 0 for w in t), n, not train[k])
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t))
        assert r.score == pytest.approx(sum(math.log10(p(g)) for g in grams(t, order)), abs=2e-4 * order * len(t))
    for k in times:  # some contexts of each order are dealt by the n-gram
        assert sum(m > max(n / 64, 100) for m in context[k].values()) >= 2
    # probabilities after a context add up to one with the unknown words'
    assert sum(p((*["w1"] * (order - 1), w)) for w in c) + p((*["w1"] * (order - 1), "unknown!")) == pytest.approx(1)


def test_hot_context_with_one_successor_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 16)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 40)
    learned = [k for k in range(400) if zlib.crc32(str(k).encode()) % 7 != 2][:200]
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 7 == 2][:30]
    rows = [(k, f"the cat w{j % 20}") for j, k in enumerate(learned)] + [(k, f"the w{j % 20}") for j, k in enumerate(held)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    got = {r.doc_id: r.score for r in lm.score(spark.createDataFrame(rows, schema), Scratch(spark, "t")).collect()}
    # 800 tokens: the, cat and the end are hot; each of 20 words comes 10 times and is always the last of its text
    d, end, low = 0.5, (200 - 0.5) / 800, (10 - 0.5) / 800
    the = (200 - 0.5) / 800
    for k in held:
        first = (200 - 0.75) / 200 + 0.75 / 200 * the
        unseen = 0.75 / 200 * low
        final = (10 - 0.75) / 10 + 0.75 / 10 * end
        assert d and got[k] == pytest.approx(sum(map(math.log10, (first, unseen, final))), abs=1e-3)


def test_counts_and_names_are_wide():
    x = np.array([0, 5_000_000_000, 2**62 + 1, 255, 256], np.int64)
    assert (lm._from_planes(lm._planes(x)) == x).all() and len(lm._from_planes(lm._planes(x[:0]))) == 0 and len(lm._planes(np.arange(256))) == 257
    assert lm._added(np.array([0, 1, 0]), np.array([2**60 + 1, 7, 2**53 + 1]), 2).tolist() == [2**60 + 2**53 + 2, 7]
    # successors whose names differ in their last bits only, in a context of many
    names = np.sort(np.array([*range(300), (1 << 56) - 1], np.uint64) * np.uint64(1) | np.uint64(5 << 40))
    context = np.full(len(names), 7, np.uint64)
    made, *_ = lm.shard_trie(context, names, np.arange(1, len(names) + 1), np.zeros(0, np.uint64), np.zeros(0, np.int64), 1e9)
    trie = eliasfano.NgramTrie(made)
    asked = np.concatenate([names[::7], names[::7] ^ np.uint64(1 << 50)])
    code, left = trie.lookup(np.full(len(asked), 7, np.uint64), asked)
    p = (np.arange(1, len(names) + 1) - 0.75) / np.arange(1, len(names) + 1).sum()
    assert (code[: len(names[::7])] == eliasfano.quantised(p[::7])).all() and not code[len(names[::7]) :].any() and left.all()
    assert not any(x.any() for x in trie.lookup(np.full(3, 8, np.uint64), names[:3]))


def test_a_part_searches_equal_questions_once_and_in_order(monkeypatch):
    rng = np.random.default_rng(4)
    names = np.unique(rng.integers(0, 1 << 56, 600, dtype=np.uint64))
    context = np.repeat(np.unique(rng.integers(0, 1 << 63, 20, dtype=np.uint64)), 30)[: len(names)]
    order = np.lexsort((names, context))
    context, names = context[order], names[order]
    made, *_ = lm.shard_trie(context, names, np.arange(1, len(names) + 1), np.zeros(0, np.uint64), np.zeros(0, np.int64), 1e9)
    trie, asked, search = eliasfano.NgramTrie(made), [], eliasfano.EliasFano.successor

    def successor(self, x, *more):
        asked.append(x)
        return search(self, x, *more)

    once = trie.lookup(context, names)
    monkeypatch.setattr(eliasfano.EliasFano, "successor", successor)
    blocks = [order[rng.permutation(len(order))] for _ in range(50)]  # many blocks ask the same, in orders of their own
    at = np.concatenate(blocks)
    code, left = trie.lookup(context[at], names[at])
    assert (code == once[0][at]).all() and (left == once[1][at]).all() and once[0].all() and once[1].all()
    assert sum(map(len, asked)) == len(names) + len(np.unique(context)) and all((x[1:] >= x[:-1]).all() for x in asked)


def test_pairs_and_order_of_rows():
    rng = np.random.default_rng(6)
    for n, most in ((0, 1), (1, 1), (500, 8), (500, 2**30)):  # the last do not fit beside their rows
        major, minor = rng.integers(0, most, (2, n))
        first, second, which = lm._pairs(major, minor)
        assert list(zip(first.tolist(), second.tolist())) == sorted(set(zip(major.tolist(), minor.tolist())))
        assert (first[which] == major).all() and (second[which] == minor).all()
    few = rng.integers(0, 4, 900, dtype=np.uint64)
    close = rng.integers(0, 9, 900, dtype=np.uint64)
    for key, name in ((few << np.uint64(60), close), (few, close), (rng.integers(0, 1 << 63, 900, dtype=np.uint64), close << np.uint64(40)), (few << np.uint64(60), rng.integers(0, 1 << 56, 900, dtype=np.uint64))):
        order = lm._ordered(key, name)  # the first two: keys or names that differ in their last bits only
        assert list(zip(key[order].tolist(), name[order].tolist())) == sorted(zip(key.tolist(), name.tolist())) and (np.sort(order) == np.arange(900)).all()
    hot = np.unique(np.concatenate([few[:2], rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    assert (lm._among(few, hot) == np.isin(few, hot)).all() and not lm._among(few, hot[:0]).any() and not len(lm._among(few[:0], hot))


def _asked(blocks, rng):
    """Messages of many blocks that share a word, and a context with its successor, and have a few others each."""
    shared = np.array([5], np.uint64)
    for block in range(blocks):
        some = np.unique(np.concatenate([shared, rng.integers(0, 4000, 30, dtype=np.uint64)]))
        yield {"block": block, "a": some.tobytes(), "b": lm._planes(np.ones(len(some), np.int64)), "c": lm._pack_names(some << np.uint64(64 - lm.NAME_BITS)), "d": lm._planes((some % 3).astype(np.int64))}


def test_a_shard_holds_what_is_distinct_however_many_blocks_ask(monkeypatch):
    import tempfile
    import tracemalloc

    monkeypatch.setattr(lm, "PART", 4000)
    monkeypatch.setattr(lm, "SPOOL", 1 << 16)
    most = {}
    for blocks in (1000, 8000):
        with tempfile.SpooledTemporaryFile(lm.SPOOL) as words, tempfile.SpooledTemporaryFile(lm.SPOOL) as grams:
            tracemalloc.start()
            word, count = lm._word_sums(_asked(blocks, np.random.default_rng(1)), words)
            context, name, times = lm._gram_sums(({**r, "b": lm._planes(np.ones(len(r["a"]) // 8, np.int64))} for r in _asked(blocks, np.random.default_rng(1))), grams)
            places = [block for part in lm._parts(words, lambda r: len(r[1]) // 8) for block, _ in part]
            most[blocks] = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert places == list(range(blocks)) and max(len(p) for p in lm._parts(words, lambda r: len(r[1]) // 8)) < 400
            assert [b for p in lm._parts(grams, lambda r: len(r[3])) for b, *_ in p] == places
        wanted = Counter(w for r in _asked(blocks, np.random.default_rng(1)) for w in np.frombuffer(r["a"], np.uint64).tolist())
        assert dict(zip(word.tolist(), count.tolist(), strict=True)) == wanted and wanted[5] == blocks
        assert dict(zip(zip(context.tolist(), name.tolist()), times.tolist(), strict=True)) == {(w, w): n * (w % 3) for w, n in wanted.items() if w % 3}
    assert most[8000] < 1.3 * most[1000] + (1 << 20)


def test_messages_of_a_shard_without_entries():
    import tempfile

    with tempfile.SpooledTemporaryFile(lm.SPOOL) as held:
        assert [len(x) for x in lm._word_sums(iter(()), held)] == [0, 0] and [len(x) for x in lm._gram_sums(iter(()), held)] == [0, 0, 0] and not list(lm._parts(held, len))


def test_model_without_training(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    got = lm.score(spark.createDataFrame([(None, "a b"), (None, None)], schema), Scratch(spark, "t")).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.held_out, r.score) for r in got} == {(3, 0, 0, False, 0.0), (1, 0, 0, False, 0.0)}
    assert lm.score(spark.createDataFrame([], schema), Scratch(spark, "t")).count() == 0


def test_model_beats_its_base_on_held_out_texts(spark, sf_dir):
    got = queries.op8_ngram_lm(spark, sf_dir).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b


# ---- warc


RECORD = "record_id string, kind string, url string, at long, headers map<string,string>, target_id string"


def test_revisits(spark):
    f = lambda i, at, url="http://www.A.com/x/", **h: (i, "response", url, at, {k.replace("_", "-"): v for k, v in h.items()}, "x")
    r = lambda i, at, url="https://a.com/x?utm_source=z#q", **h: (i, "revisit", url, at, {k.replace("_", "-"): v for k, v in h.items()}, "x")
    rows = [
        f("f1", 10, etag='"1"', content_type="t1", date="d1"), f("f2", 20, etag='"2"', last_modified="m", content_length="9"), f("f2b", 20, etag='"2b"'), f("o", 5, "http://b.com"),
        r("at10", 10, etag='"1"'), r("at11", 11, etag='W/"1"', date="d2", content_length="0", set_cookie="c"), r("at20", 20, etag='"1"'), r("at21", 21, etag='"2b"'), r("bad", 30, etag='"1"'), r("none", 30), r("since", 6, "b.com:80/index.html", last_modified="m"), r("null", 9, None, etag="1"), ("late", "revisit", "a.com/x", None, None, "x"), ("meta", "metadata", "a.com/x", 40, {}, "x"),
    ]
    got = {x.record_id: x for x in warc.resolve(spark.createDataFrame(rows, RECORD)).collect()}
    assert {k: (v.status, v.target_id) for k, v in got.items()} == {
        "at10": ("no_earlier_response", None), "at11": ("resolved", "f1"), "at20": ("resolved", "f1"), "at21": ("resolved", "f2b"), "bad": ("validator_mismatch", None), "none": ("no_validator", None), "since": ("validator_mismatch", None), "null": ("no_earlier_response", None), "late": ("no_earlier_response", None),
    }
    assert got["at11"].headers == {"etag": 'W/"1"', "date": "d2", "content-type": "t1"}
    assert warc.resolve(spark.createDataFrame([], RECORD)).count() == 0


def test_repeated_records_and_null_ids(spark):
    h = {"etag": "e"}
    rows = [("f", "response", "a.com", 5, h | {"x": "1"}, "x"), ("f", "response", "a.com", 5, h | {"x": "2"}, "x"), (None, "response", "a.com", 7, h, "x"), ("r", "revisit", "a.com", 9, h, "x"), ("r", "revisit", "a.com", 9, h, "x"), (None, "revisit", "a.com", 8, h, "x"), (None, "revisit", "a.com", 4, h, "x"), (None, "revisit", None, 4, None, None)]
    got = sorted(((x.record_id, x.at, x.status, x.target_id, sorted(x.headers.items())) for x in warc.resolve(spark.createDataFrame(rows, RECORD)).collect()), key=repr)
    stored = [("etag", "e"), ("x", "2")]
    assert got == sorted([("r", 9, "resolved", "f", stored)] * 2 + [(None, 8, "resolved", "f", stored), (None, 4, "no_earlier_response", None, [("etag", "e")]), (None, 4, "no_earlier_response", None, [])], key=repr)


@pytest.mark.parametrize("wrong", [None, 10**15])
def test_revisits_are_brute_force(spark, monkeypatch, wrong):
    import random

    rng = random.Random(9)
    rows = [(f"{k:04d}", rng.choice(["response", "revisit"]), f"http://h.com/{rng.choice('aaaabc')}", rng.randrange(60), {"etag": "e"}, "x") for k in range(600)]
    if wrong:
        rows.append(("9999", "response", "http://h.com/a", wrong, {"etag": "e"}, "x"))
        monkeypatch.setattr(warc, "SLICES", 8)
        monkeypatch.setattr(warc, "STEP", 2)
    got = {r.record_id: r.target_id for r in warc.resolve(spark.createDataFrame(rows, RECORD)).collect()}
    for i, kind, url, at, *_ in rows:
        if kind == "revisit":
            before = [(a, j) for j, k, u, a, *_ in rows if k == "response" and u == url and a < at]
            assert got[i] == (max(before)[1] if before else None)


def test_urls(spark):
    urls = ["HTTP://User@www.Ex.com:80/a/index.html?b=2&utm_x=1&a=1#f", "//m.ex.com/a?ref=q", "ex.com", "", None, "https://ex.com/A/?", "http://ex.com:8080/p?refer=1"]
    got = [r.u for r in spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").orderBy("i").select(warc.canonical_url(F.col("u")).alias("u")).collect()]
    assert got == ["ex.com/a?a=1&b=2", "ex.com/a", "ex.com", None, None, "ex.com/A", "ex.com:8080/p?refer=1"]


def test_read_warc_files(spark, tmp_path):
    def record(kind, i, body, more=""):
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{i}>\r\nWARC-Target-URI: http://a.com/\r\nWARC-Date: 2024-01-0{i}T00:00:00Z\r\n{more}Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"

    full = record("response", 1, b"HTTP/1.1 200 OK\r\nETag: x\r\nContent-Type: text/html\r\n\r\n<p>body WARC/1.0</p>")
    again = record("revisit", 2, b"HTTP/1.1 304 Not Modified\r\nETag: x\r\nDate: now\r\n\r\n", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/server-not-modified\r\n")
    same = record("revisit", 3, b"", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n")
    (tmp_path / "a.warc").write_bytes(full + again + same + b"WARC/1.0\r\nContent-Length: many\r\n\r\n" + full.replace(b"<1>", b"<4>") + b"WARC/1.0\r\nContent-Length: 99\r\n\r\ncut")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(full.replace(b"<1>", b"<9>")) + gzip.compress(again.replace(b"<2>", b"<8>"))[:-9])
    records = warc.read(spark, str(tmp_path))
    assert sorted((r.record_id, r.kind) for r in records.collect()) == [("<1>", "response"), ("<2>", "revisit"), ("<3>", "other"), ("<4>", "response"), ("<8>", "revisit"), ("<9>", "response")]
    out = warc.with_bodies(warc.resolve(records.drop("body")), records).where("record_id = '<2>'").first()
    assert out.status == "resolved" and bytes(out.body) == b"<p>body WARC/1.0</p>" and out.headers == {"etag": "x", "date": "now", "content-type": "text/html"}


def test_bodies_of_repeated_responses_are_one(spark):
    rows = [("r", "response", "http://a.com/", 1, {"etag": "x"}, b"one"), ("r", "response", "http://a.com/", 1, {"etag": "x"}, b"two"), ("r", "response", "http://b.com/", 1, {"etag": "a"}, b"zzz"), ("q", "response", "http://c.com/", 1, None, b"other")]
    rows += [("v", "revisit", "http://a.com/", 5, {"etag": "x"}, None)] * 2 + [("w", "revisit", "http://a.com/", 5, {"etag": "no"}, None), ("n", "revisit", None, 5, None, None)]
    records = spark.createDataFrame(rows, "record_id string, kind string, url string, at long, headers map<string,string>, body binary")
    out = warc.with_bodies(warc.resolve(records), records)
    assert out.columns == ["record_id", "canonical_url", "at", "status", "target_id", "headers", "body"]
    assert sorted((r.record_id, r.status, r.body and bytes(r.body)) for r in out.collect()) == [("n", "no_earlier_response", None), ("v", "resolved", b"two"), ("v", "resolved", b"two"), ("w", "validator_mismatch", None)]


# ---- pipeline


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps, out = [docs], Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES:
        steps.append(out.put(stage(spark, steps[-1], sf_dir), name))
    good, spoken, unique, mix, coded = steps[1:]
    assert all(s.columns == docs.columns for s in (good, spoken, unique, mix))
    kept = lambda s: {r.doc_id for r in s.select("doc_id").collect()}
    rows = [(r.doc_id, r.text) for r in spoken.collect()]
    assert kept(unique) == {i for i, (_, _, first) in brute.near_duplicates(rows).items() if first} and unique.count() == len(kept(unique))
    sizes = Counter()
    for r in unique.collect():
        sizes[r.source] += len(brute.words(r.text))
    wanted, taken = brute.targets(sizes), Counter()
    for r in mix.collect():
        taken[r.source] += len(brute.words(r.text))
    longest = max(len(brute.words(t)) for _, t in rows)
    assert all(abs(taken[s] - wanted[s]) <= longest for s in sizes)
    assert coded.count() == mix.count() and coded.where("n_tokens <> size(ids) OR n_tokens = 0").count() == 0
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = {i for i, q in labels.items() if q == 1}
    assert len(clean & kept(spoken)) >= 0.97 * len(clean)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect()) == sorted(tuple(r) for r in coded.select("doc_id", "n_tokens").collect())


def test_dedup_tells_rows_of_one_id_apart(spark):
    one, two, three, four = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(1, one, "s"), (1, two, "s"), (2, two + " end", "s"), (1, one, "s"), (3, three, "s"), (None, three, "s"), (None, four, "s"), (None, four, "t"), (None, four + " end", "s"), (None, None, "s"), (None, " ", "s"), (-5, three, "s"), (2**63 - 1, "x y z", "s"), (-(2**63), "x y", "s"), (7, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.dedup_stage(spark, docs, "").collect()), key=repr)
    last = [r for r in got if r[0] is None and (r[1] or "").startswith("d0")]
    assert len(last) == 1
    assert sorted([x for x in got if x not in last], key=repr) == sorted([(1, one), (1, two), (-5, three), (None, None), (None, " "), (2**63 - 1, "x y z"), (-(2**63), "x y"), (7, "")], key=repr)


def test_pipeline_stages_on_hard_rows(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    good = "The cat sat on the mat, and it was good. He said so to us, for that is what we do. "
    rows = [(k, good + f"Thing {k}.", "en", "a", 1) for k in range(5)] + [(None, good, None, None, None), (7, None, None, None, None), (8, "", "en", "b", 0), (1, good + "Thing 1.", "en", "a", 1), (9, good * 800, "en", "a", 1)]
    docs = spark.createDataFrame(rows, schema)
    out = {}
    for name, stage in corpus_pipeline.STAGES:  # each stage on the whole table: every case has a result
        out[name] = sorted(((r.doc_id, r.n_tokens) if name == "encoding" else (r.doc_id, r.text) for r in stage(spark, docs, sf_dir).collect()), key=repr)
    texts = sorted(((r[0], r[1]) for r in rows), key=repr)
    spoken = [r for r in texts if r[1]]
    assert out["quality"] == spoken and out["language"] == spoken
    # all spoken texts are near-duplicates of each other; the null and the empty text have ids and are no one's
    assert out["dedup"] == sorted([(0, good + "Thing 0."), (7, None), (8, "")], key=repr)
    assert {i for i, _ in out["mixing"]} <= {i for i, _ in texts} and len(out["mixing"]) >= len(spoken) and all(n <= 2 * texts.count(r) for r, n in Counter(out["mixing"]).items())
    assert len(out["encoding"]) == len(rows) and {i: n for i, n in out["encoding"]}[7] == 0 and all(n > 10 for i, n in out["encoding"] if i not in (7, 8))
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_the_query_learns_trigrams(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = lambda df: {r.doc_id: r.score for r in df.collect()}
    got = scores(queries.op8_ngram_lm(spark, sf_dir))
    assert got == scores(lm.score(docs, Scratch(spark, "trigrams"), order=3)) != scores(lm.score(docs, Scratch(spark, "bigrams"), order=2))


def test_questions_are_asked_and_texts_scored_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(5)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    docs = spark.createDataFrame([(k, " ".join(f"w{min(int(x), 300)}" for x in rng.zipf(1.2, 40))) for k in range(300)], schema)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lm, "HOT", 64)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 1000)
    put, steps = Scratch.put, {}

    def kept(self, df, label="step", *more):
        out = put(self, df, label, *more)
        steps.setdefault(label, []).append({(r.block, r.shard) for r in out.where(F.col("kind") >= lm.GRAMS).select("block", "shard").collect()} if label.startswith("grams") else out.count())
        return out

    monkeypatch.setattr(Scratch, "put", kept)
    scores = []
    for tokens in (1 << 40, 1000):
        steps.clear()
        monkeypatch.setattr(lm, "ROUND_TOKENS", tokens)
        scores.append({tuple(r) for r in lm.score(docs, Scratch(spark, "t"), order=3).collect()})
        rounds = 1 if tokens > 1000 else lm.ROUNDS
        for label in ("grams2", "grams3"):  # no message of a round is one of another, and together they are those of one round
            of = -(-rounds // 2) if label == "grams2" else rounds
            assert len(steps[label]) == of and sum(map(len, steps[label])) == len(set().union(*steps[label])) and max(map(len, steps[label])) < 2 / of * sum(map(len, steps[label]))
    assert scores[0] == scores[1] and len(scores[0]) == 300
    assert len(steps["scores"]) == lm.ROUNDS and sum(steps["scores"]) == 300
