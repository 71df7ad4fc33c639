"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoframe.llm import bpe, decontaminate, embedding_dedup, hilbert, html, langid, lm, minhash, mixing, phrases, quality, warc
from genoframe.llm.scratch import Scratch

#: The public vocabularies' folder is found on each machine; every path is a parameter of the operators.
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_first_position(mixing.mix(_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "passes", F.round("position", 9).alias("position"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary(BYTE_BPE)
    both = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def revisit_records(pages: DataFrame) -> DataFrame:
    """Two captures of every page: a full response, and a later or sometimes earlier not-modified revisit of another
    spelling of its address; every fifth revisit has a changed entity tag, every seventh none, every 35th no validator."""
    i, at = F.col("page_id"), (F.col("page_id") * 7919) % 1000003
    tag, since = F.md5(F.coalesce("html", F.lit("")).cast("binary")), (at - at % 3600).cast("string")
    second = at + (i * 31) % 5000 - 500
    full = F.create_map(*map(F.lit, ("content-type", "text/html", "cache-control", "max-age=60")), F.lit("etag"), tag, F.lit("last-modified"), since, F.lit("content-length"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"))
    tags = F.when(i % 7 == 0, F.lit(None)).when(i % 5 == 0, F.lit("changed")).otherwise(F.concat(F.lit("W/"), tag))
    again = F.create_map(F.lit("cache-control"), F.concat(F.lit("max-age="), (i % 100).cast("string")), F.lit("date"), second.cast("string"), F.lit("content-length"), F.lit("0"), F.lit("etag"), tags, F.lit("last-modified"), F.when(i % 35 != 0, since))
    rows = pages.select(
        F.explode(
            F.array(
                F.struct((i * 2).alias("record_id"), F.lit("response").alias("kind"), F.col("url").alias("url"), at.alias("at"), full.alias("headers")),
                F.struct((i * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.concat("url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_source=again#top")).alias("url"), second.alias("at"), F.map_filter(again, lambda _, v: v.isNotNull()).alias("headers")),
            )
        ).alias("r")
    )
    return rows.select("r.*")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.resolve(revisit_records(_table(spark, sf_dir, "pages")))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "; ")
    return out.select("record_id", "canonical_url", "at", "status", "target_id", listed.alias("headers"))


def op5_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, Scratch(spark, "op5"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark, "op6"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs))


def op8_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"), Scratch(spark, "op8"), order=3)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _table(spark, sf_dir, "documents"), vocabulary(PIECES)
    out = langid.predict(docs, path, *langid.train(docs, path))
    return out.select("doc_id", F.coalesce(~langid.learns(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op10"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.flags(decontaminate.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents"), Scratch(spark, "op12"))


QUERIES = {"op1_html": op1_html, "op2_mixing": op2_mixing, "op3_bpe": op3_bpe, "op4_warc_revisits": op4_warc_revisits, "op5_hilbert_ann": op5_hilbert_ann, "op6_minhash": op6_minhash, "op7_quality": op7_quality, "op8_ngram_lm": op8_ngram_lm, "op9_language_id": op9_language_id, "op10_embedding_dedup": op10_embedding_dedup, "op11_decontamination": op11_decontamination, "op12_phrases": op12_phrases}

#: One demand inverse for each parity of a source's place: time steps of a quarter, weights 4 3 2 1 or 1 2 3 4 (integral 2.5).
_OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY cap / weight, place) AS k,
             coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS full_before,
             CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS weight_left,
             CAST(sum(source_size) OVER () AS BIGINT) AS total FROM w),
l AS (SELECT *, (total * 1.5::DOUBLE - full_before) / weight_left AS level FROM f),
t AS (SELECT source, place, source_size, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(level, k) FROM l WHERE cap > level * weight) * weight, CAST(cap AS DOUBLE))) AS target FROM l),
p AS (SELECT doc_id, size, source_size, target, place,
             coalesce(CAST(sum(size) OVER (PARTITION BY d.source ORDER BY tie, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) + size / 2.0::DOUBLE AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, CAST((middle < target)::INT + (source_size + middle < target)::INT AS INTEGER) AS passes, least(middle / greatest(target, 1.0), 1.0) * 2.5 AS u FROM p)
SELECT doc_id, size, source_size, target, size * passes AS taken, passes,
  CASE WHEN passes = 0 THEN NULL WHEN place % 2 = 0 THEN
    round(CASE WHEN u < 1.0 THEN u / 4 WHEN u < 1.75 THEN 0.25 + (u - 1.0) / 3 WHEN u < 2.25 THEN 0.5 + (u - 1.75) / 2 WHEN u < 2.5 THEN 0.75 + (u - 2.25) ELSE 1.0 END, 9)
  ELSE
    round(CASE WHEN u < 0.25 THEN u WHEN u < 0.75 THEN 0.25 + (u - 0.25) / 2 WHEN u < 1.5 THEN 0.5 + (u - 0.75) / 3 WHEN u < 2.5 THEN 0.75 + (u - 1.5) / 4 ELSE 1.0 END, 9) END AS position
FROM q
"""

_OP4_SQL = r"""
WITH p AS (SELECT page_id AS i, url, coalesce(html, '') AS html, page_id * 7919 % 1000003 AS "at" FROM pages),
x AS (SELECT *, md5(html) AS tag, CAST("at" - "at" % 3600 AS VARCHAR) AS since, "at" + i * 31 % 5000 - 500 AS second FROM p),
u AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?', '') AS bare FROM x),
q AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^(?:www|m)\.', ''), ':(?:80|443)$', '')
        || regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/index\.html?$', '/'), '/+$', '') AS place,
      array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda e: e <> '' AND NOT regexp_matches(e, '^(?:utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(?:=|$)'))), '&') AS params FROM u),
c AS (SELECT *, CASE WHEN params = '' THEN nullif(place, '') ELSE place || '?' || params END AS canonical_url FROM q),
full_ AS (SELECT canonical_url AS target_url, "at" AS target_at, max(i * 2) AS target_id FROM c WHERE canonical_url IS NOT NULL GROUP BY ALL),
again AS (SELECT i * 2 + 1 AS record_id, canonical_url, second AS "at", i, since, CASE WHEN i % 7 = 0 THEN NULL WHEN i % 5 = 0 THEN 'changed' ELSE 'W/' || tag END AS etag, CASE WHEN i % 35 <> 0 THEN since END AS modified FROM c),
j AS (SELECT a.*, f.target_id FROM again a ASOF LEFT JOIN full_ f ON a.canonical_url = f.target_url AND a."at" > f.target_at),
k AS (SELECT j.*, c.tag AS stored_tag, c.since AS stored_since, c.html,
      CASE WHEN target_id IS NULL THEN 'no_earlier_response' WHEN etag IS NULL AND modified IS NULL THEN 'no_validator'
           WHEN etag IS NOT NULL AND regexp_replace(etag, '^W/', '') = c.tag THEN 'resolved' WHEN etag IS NULL AND modified = c.since THEN 'resolved'
           ELSE 'validator_mismatch' END AS status FROM j LEFT JOIN c ON target_id = c.i * 2)
SELECT record_id, canonical_url, "at", status, CASE WHEN status = 'resolved' THEN target_id END AS target_id,
  CASE WHEN status = 'resolved' THEN concat_ws('; ', 'cache-control: max-age=' || i % 100, 'content-length: ' || strlen(html), 'content-type: text/html', 'date: ' || "at", 'etag: ' || coalesce(etag, stored_tag), 'last-modified: ' || stored_since)
  ELSE concat_ws('; ', 'cache-control: max-age=' || i % 100, 'content-length: 0', 'date: ' || "at", 'etag: ' || etag, 'last-modified: ' || modified) END AS headers
FROM k
"""

#: Exact all-pairs shingle similarity and reachability.
_OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.id FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(id) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

_OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(vec_id, id) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.id FROM r JOIN l ON l.a = r.vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = r.vec_id) AS n_links, min(id) AS component_id, vec_id = min(id) AS kept FROM r GROUP BY vec_id
"""

#: Windows of every item, as phrases, met by the phrases of each document that have their number of words.
_OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
z AS (SELECT item_id, w, CAST(least(len(w), 10) AS BIGINT) AS m FROM i WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, m, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - m + 2), lambda k: array_to_string(w[k:k + m - 1], ' '))) AS phrase FROM z),
x AS (SELECT r, m, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - m + 2), lambda k: {'k': k, 'phrase': array_to_string(w[k:k + m - 1], ' ')})) AS at FROM d, (SELECT DISTINCT m FROM p)),
h AS (SELECT x.r, x.at.k AS k, x.m, p.item_id FROM x JOIN p ON p.m = x.m AND p.phrase = x.at.phrase),
c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + m)) AS place FROM h) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY encode(name)) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN n ON n.r = d.r
"""

#: All phrases of up to five words counted, scored at every cut.
_OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, CAST(len(w) AS BIGINT) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) t(k)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k >= 2 AND f >= 100),
o AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c q WHERE q.lang = c.lang AND q.k > c.k AND 100 * q.a >= 100 * c.a AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))),
s AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM o)),
t AS (SELECT s.lang, s.phrase, a, j, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM s JOIN g l ON l.lang = s.lang AND l.phrase = s.x JOIN g r ON r.lang = s.lang AND r.phrase = s.y JOIN n ON n.lang = s.lang),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b) WHERE rank <= 2000
"""

ORACLES = {"op2_mixing": _OP2_SQL, "op4_warc_revisits": _OP4_SQL, "op6_minhash": _OP6_SQL, "op10_embedding_dedup": _OP10_SQL, "op11_decontamination": _OP11_SQL, "op12_phrases": _OP12_SQL}
