"""SQL of the registered queries, for an engine of another make; written from the semantics, not from the frames."""

from __future__ import annotations

from genoframe.plans.views import FAM_SQL, G_SQL, MODELS, R_SQL, T_SQL, V_SQL

_CODE = "CASE WHEN alt = '*' THEN 'SPANNING_DELETION' WHEN starts_with(alt, '<') AND ends_with(alt, '>') THEN 'SYMBOLIC_ALT' WHEN contains(alt, '[') OR contains(alt, ']') THEN 'BREAKEND' WHEN alt = ref THEN 'REF_EQUALS_ALT' WHEN alt IN ('', '.') THEN 'MISSING_ALT' END"
_LABELS = "CASE WHEN feature = 'exon' THEN [CASE WHEN biotype = 'protein_coding' THEN 'exonic' ELSE 'noncoding_gene' END] WHEN feature IN ('splice_donor', 'splice_acceptor') THEN ['splice_site', 'splice_region'] WHEN feature = 'intron' THEN ['intronic'] ELSE [feature] END"
_SEVERITY = "['splice_site','cds','splice_region','five_prime_utr','three_prime_utr','exonic','noncoding_gene','intronic','promoter','intergenic']"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_SEQ = "translate(lower(text), 'bdefhijklmnopqrsuvwxyz .acgt', 'ACGTACGTACGTACGTACGTACGTACGT')"

#: Named parts; each query takes what it needs.
_PARTS = {
    "v": V_SQL,
    "r": R_SQL,
    "g": G_SQL,
    "t": T_SQL,
    "ord_v": f"SELECT *, row_number() OVER (ORDER BY {_ORDER}) - 1 AS record_ordinal FROM v",
    "o0": "SELECT *, unnest(string_split(alt_raw, ',')) AS alt, generate_subscripts(string_split(alt_raw, ','), 1) AS alt_index FROM ord_v",
    "o": f"SELECT * EXCLUDE (alt_raw), {_CODE} AS error_code FROM o0",
    "k": "SELECT *, chrom || ':' || pos || ':' || ref || ':' || alt AS canonical_id FROM o WHERE error_code IS NULL",
    "s": "SELECT DISTINCT chrom, pos, ref, pos + length(ref) - 1 AS v_end FROM v",
    "hits": f"SELECT s.chrom, s.pos, s.ref, unnest({_LABELS}) AS label, gene_id FROM s JOIN r ON r.chrom = s.chrom AND r.start_ <= s.v_end AND r.end_ >= s.pos",
    "lab": f"SELECT s.chrom, s.pos, s.ref, coalesce(list_filter({_SEVERITY}, lambda x: list_contains(list(label), x)), []) AS found, coalesce(list_sort(list_distinct(list_filter(list(gene_id), lambda x: x IS NOT NULL))), []) AS gene_ids FROM s LEFT JOIN hits ON s.chrom = hits.chrom AND s.pos = hits.pos AND s.ref = hits.ref GROUP BY s.chrom, s.pos, s.ref",
    "ann": "SELECT chrom, pos, ref, CASE WHEN len(found) = 0 THEN ['intergenic'] ELSE found END AS labels, gene_ids FROM lab",
    "cat(category, needs)": "VALUES ('coding', ['cds']), ('exonic', ['exonic']), ('five_prime_utr', ['five_prime_utr']), ('three_prime_utr', ['three_prime_utr']), ('splice', ['splice_site', 'splice_region']), ('splice_site', ['splice_site']), ('splice_region', ['splice_region']), ('intronic', ['intronic']), ('promoter', ['promoter']), ('noncoding_gene', ['noncoding_gene']), ('genic', ['cds', 'exonic', 'five_prime_utr', 'three_prime_utr', 'splice_site', 'splice_region', 'intronic', 'noncoding_gene']), ('intergenic', ['intergenic'])",
    "am0": "SELECT chrom, pos, ref, alt, min(l_partkey) AS pk, max(l_linenumber) AS ln FROM o WHERE error_code IS NULL AND l_partkey % 3 = 0 GROUP BY ALL",
    "am": "SELECT chrom, pos, ref, alt, 'T' || t AS transcript_id, round((pk % 1000) / 1000.0::DOUBLE, 3) AS score, CASE WHEN pk % 1000 < 340 THEN 'benign' WHEN pk % 1000 < 564 THEN 'ambiguous' ELSE 'pathogenic' END AS class FROM (SELECT *, unnest(range(1, ln % 3 + 2)) AS t FROM am0)",
    "i0": "SELECT *, lead(start_) OVER (PARTITION BY tx ORDER BY start_, end_, l_partkey) AS next_start FROM t",
    "i": "SELECT tx, chrom, strand, end_ AS exon_end, next_start, end_ + 1 AS a, next_start - 1 AS b FROM i0 WHERE next_start > end_ + 1",
    "sites": "SELECT tx, chrom, CASE WHEN strand = '+' THEN 'splice_donor' ELSE 'splice_acceptor' END AS kind, a AS start, least(a + 1, b) AS \"end\" FROM i UNION ALL SELECT tx, chrom, CASE WHEN strand = '+' THEN 'splice_acceptor' ELSE 'splice_donor' END, greatest(b - 1, a), b FROM i",
    "zones": "SELECT tx, chrom, 'left' AS side, exon_end - 2 AS start, least(a + 7, b) AS \"end\" FROM i UNION ALL SELECT tx, chrom, 'right', greatest(b - 7, a), next_start + 2 FROM i",
    "prom": "SELECT gene_id, chrom, greatest(CASE WHEN strand = '+' THEN start_ - 500 ELSE end_ - 100 END, 1) AS start, CASE WHEN strand = '+' THEN start_ + 100 ELSE end_ + 500 END AS \"end\" FROM g",
    "whole": "SELECT * FROM (SELECT 'exon' AS feature, chrom, start_ AS start, end_ AS \"end\" FROM t UNION ALL SELECT 'intron', chrom, a, b FROM i UNION ALL SELECT kind, chrom, start, \"end\" FROM sites UNION ALL SELECT 'splice_region', chrom, start, \"end\" FROM zones UNION ALL SELECT 'promoter', chrom, start, \"end\" FROM prom) WHERE \"end\" >= start",
    "c": f"SELECT doc_id AS contig, {_SEQ} AS seq FROM documents",
    "sv": "SELECT contig AS id, seq, CASE WHEN contig % 30 < 22 THEN 'chr' || (contig % 30 + 1) WHEN contig % 30 = 22 THEN 'chrX' WHEN contig % 30 = 23 THEN 'chrY' WHEN contig % 30 = 24 THEN 'chrM' ELSE 'chr' || contig % 30 END AS chrom, contig * 7919 % greatest(length(seq), 1) + 1 AS pos, CASE WHEN contig % 11 = 0 THEN 'GATTACA' ELSE substring(seq, contig * 7919 % greatest(length(seq), 1) + 1, 1 + contig % 3) END AS ref, CASE contig % 7 WHEN 0 THEN 'n' WHEN 1 THEN 'GATTACA' WHEN 2 THEN '' ELSE 'T' END AS alt FROM c",
    "w": "SELECT *, substring(seq, greatest(pos - 20, 1), least(pos - 1, 20)) || alt || substring(seq, pos + length(ref), greatest(20 - length(alt), 0)) AS alt_seq FROM sv",
    "valid": "SELECT id, CASE WHEN id % 17 = 0 OR NOT regexp_matches(chrom, '^chr([1-9]|1[0-9]|2[0-2]|X|Y)$') THEN 'INVALID_CHROMOSOME' WHEN regexp_matches(ref, '[^ACGT]') THEN 'INVALID_REFERENCE' WHEN regexp_matches(alt, '[^ACGT]') THEN 'INVALID_ALTERNATE' WHEN pos <= 20 OR substring(seq, pos, least(length(ref), 20)) <> ref THEN 'REF_MISMATCH' WHEN length(alt_seq) <> 40 THEN 'ALT_LENGTH_MISMATCH' WHEN substring(alt_seq, 21, length(alt)) <> alt THEN 'ALT_MISMATCH' END AS error_code FROM w",
    "e": "SELECT a.vec_id, a.label, list_transform(a.embedding, lambda x: CAST(x AS DOUBLE)) AS x, list_transform(b.embedding, lambda x: CAST(x AS DOUBLE)) AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "sums": "SELECT vec_id, x, y, list_sum(x) AS xs, list_sum(y) AS ys FROM e",
    "soft": "SELECT vec_id, list_transform(x, lambda v: exp(v - list_max(x)) / list_sum(list_transform(x, lambda u: exp(u - list_max(x))))) AS p, list_transform(y, lambda v: exp(v - list_max(y)) / list_sum(list_transform(y, lambda u: exp(u - list_max(y))))) AS q FROM e",
    "terms": "SELECT vec_id, unnest(p) AS p, unnest(q) AS q FROM soft",
    "jsd": "SELECT vec_id, sqrt(greatest((sum(p * log2(p / ((p + q) / 2))) + sum(q * log2(q / ((p + q) / 2)))) / 2, 0)) AS jsd FROM terms GROUP BY vec_id",
    "vals": "SELECT value, row_number() OVER (ORDER BY value) - 1 AS at_, count(*) OVER () AS n FROM events WHERE value IS NOT NULL",
    "dist": "SELECT range AS i, value FROM range(1000) JOIN vals ON vals.at_ = range * n // 1000",
    "quant": "SELECT vec_id, xs, ys, greatest((SELECT count(*) FROM dist WHERE value < abs(xs) * 20), (SELECT count(*) FROM dist WHERE value < abs(ys) * 20)) / 1000.0::DOUBLE AS quantile FROM sums",
    "m": "SELECT user_id, event_type AS model_id, avg(value) / 97 - 1 AS logfc, count(*) / 30::DOUBLE AS q, max(value) > 300 AS in_peak FROM events GROUP BY ALL",
    "flag": "SELECT *, coalesce(abs(logfc) >= 0.25 AND q >= 0.05 AND (in_peak OR (NOT in_peak AND logfc > 0)), false) AS pri FROM m",
    "fam0": FAM_SQL,
    "fam": "SELECT record, member, dp, gq, record % 2 = 0 AS phased, CASE WHEN dp >= 3 THEN [a1, a2] END AS gt FROM fam0",
    "calls": "SELECT *, coalesce(list_contains(gt, alt_index), false) AS has, coalesce(gt[1] = 0 AND gt[2] = 0 AND dp >= 10 AND gq >= 20, false) AS sure, CASE WHEN gt IS NULL THEN './.' WHEN phased THEN gt[1] || '|' || gt[2] ELSE gt[1] || '/' || gt[2] END AS txt, 'I' || member AS who FROM fam, (VALUES (1), (2)) AS a(alt_index)",
    "inh": "SELECT record, alt_index, CASE WHEN bool_or(member = 2 AND has) AND bool_or(member = 3 AND has) THEN 'BIPARENTAL' WHEN bool_or(member = 2 AND has) THEN 'MATERNAL' WHEN bool_or(member = 3 AND has) THEN 'PATERNAL' WHEN bool_or(member = 2 AND sure) AND bool_or(member = 3 AND sure) THEN 'PARENTS_REFERENCE' ELSE 'UNRESOLVED' END AS inheritance FROM calls GROUP BY ALL",
    "carried": "SELECT record, alt_index FROM calls WHERE member = 1 AND has",
    "res": "SELECT record_ordinal, alt_index, 'R' || record_ordinal AS result_variant_id, l_extendedprice AS score, CASE WHEN l_partkey % 4 <> 0 THEN 'G' || l_partkey % 50 END AS gene FROM o WHERE error_code IS NULL AND record_ordinal % 7 <> 0",
    "aug": "SELECT o.record_ordinal, o.alt_index, o.alt, o.error_code, res.result_variant_id, res.score, res.gene, CASE WHEN o.error_code IS NOT NULL THEN 'UNSUPPORTED' WHEN res.result_variant_id IS NOT NULL THEN 'SCORED' ELSE 'NO_RESULT' END AS status FROM o LEFT JOIN res ON o.record_ordinal = res.record_ordinal AND o.alt_index = res.alt_index",
    "near0": "SELECT DISTINCT chrom, pos FROM v",
    "near": "SELECT p.chrom, p.pos, gene_id, start_, CASE WHEN p.pos BETWEEN start_ AND end_ THEN 0 ELSE least(abs(p.pos - start_), abs(p.pos - end_)) END AS d FROM near0 p JOIN g ON g.chrom = p.chrom",
    "near5": "SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY d, gene_id) AS rank FROM near",
    "freq0": "SELECT user_id, event_type, arg_max(value, (ts, event_id)) / 1024 AS f FROM events GROUP BY ALL",
    "freq": "SELECT user_id, " + ", ".join(f"coalesce(round_even(max(f) FILTER (event_type = '{m}'), 3), 0.0) AS af_{m}" for m in MODELS) + " FROM freq0 GROUP BY user_id",
}
_NEEDS = {
    "o0": "ord_v", "ord_v": "v", "o": "o0", "k": "o", "s": "v", "hits": "s r", "lab": "s hits", "ann": "lab", "am0": "o", "am": "am0", "i0": "t", "i": "i0", "sites": "i", "zones": "i", "prom": "g", "whole": "t i sites zones prom",
    "sv": "c", "w": "sv", "valid": "w", "sums": "e", "soft": "e", "terms": "soft", "jsd": "terms", "dist": "vals", "quant": "sums dist", "flag": "m", "fam": "fam0", "calls": "fam", "inh": "calls", "carried": "calls", "res": "o", "aug": "o res", "near0": "v", "near": "near0 g", "near5": "near", "freq": "freq0",
}


def _with(names: str, select: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for x in _NEEDS.get(name, "").split():
            add(x)
        if name not in needed:
            needed.append(name)

    for name in names.split():
        add(name)
    full = {k.split("(")[0]: k for k in _PARTS}
    return "WITH " + ",\n".join(f"{full[n]} AS ({_PARTS[full[n]]})" for n in needed) + "\n" + select


_KEYS = "l_orderkey, l_linenumber, l_partkey"
_SPAN = "chrom, pos, ref"
_RULE = "CASE WHEN category = 'intergenic' THEN labels = ['intergenic'] ELSE list_has_any(labels, needs) END"
_PIVOT = ", ".join(
    [f"round(max(logfc) FILTER (model_id = '{m}'), 6) AS logfc_{m}" for m in MODELS]
    + [f"round(max(q) FILTER (model_id = '{m}'), 6) AS active_allele_quantile_{m}" for m in MODELS]
    + [f"bool_or(in_peak) FILTER (model_id = '{m}') AS in_peak_{m}" for m in MODELS]
)
_ENTRY = " || ".join(["'1|M000' || nr", "'|' || coalesce(CAST(CAST(round(logfc * 1000) AS BIGINT) AS VARCHAR), '.')", "'|.'", "'|' || coalesce(CAST(CAST(round(q * 1000) AS BIGINT) AS VARCHAR), '.')", "'|' || CASE WHEN in_peak THEN '1' ELSE '0' END", "'|' || CASE WHEN pri THEN '1' ELSE '0' END"])

ORACLES = {
    "multiallelic_split": _with("o0", f"SELECT {_KEYS}, CAST(alt_index AS INTEGER) AS alt_index, alt FROM o0"),
    "symbolic_filter": _with("o", f"SELECT {_KEYS}, alt FROM o WHERE NOT (alt IN ('*', '.', '') OR (alt LIKE '<%' AND alt LIKE '%>') OR alt LIKE '%[%' OR alt LIKE '%]%' OR alt = ref)"),
    "alt_error_code": _with("o", f"SELECT {_KEYS}, CAST(alt_index AS INTEGER) AS alt_index, alt, error_code, CASE WHEN error_code IS NULL THEN 'PENDING' ELSE 'UNSUPPORTED' END AS status FROM o"),
    "sortedness_violations": _with("ord_v", "SELECT record_ordinal, chrom, pos FROM (SELECT *, lag((rid, pos)) OVER (ORDER BY record_ordinal) AS before_ FROM (SELECT *, l_suppkey % 25 AS rid FROM ord_v)) WHERE (rid, pos) < before_"),
    "variant_type": _with("k", "SELECT canonical_id, CAST(length(ref) AS INTEGER) AS ref_length, CAST(length(alt) AS INTEGER) AS alt_length, CAST(greatest(length(ref), length(alt)) AS INTEGER) AS variant_length, CASE WHEN length(alt) > length(ref) THEN 'insertion' WHEN length(alt) < length(ref) THEN 'deletion' WHEN length(ref) = 1 THEN 'SNV' ELSE 'substitution' END AS variant_type FROM k"),
    "canonical_dedup": _with("k", f"SELECT DISTINCT canonical_id, {_SPAN}, alt FROM k"),
    "ingest_counts": _with("k", "SELECT (SELECT count(*) FROM v) AS record_count, (SELECT count(*) FROM o) AS alt_count, (SELECT count(*) FROM k) AS valid_count, (SELECT count(*) FROM o WHERE error_code IS NOT NULL) AS unsupported_count, CAST(0 AS BIGINT) AS target_excluded_count, (SELECT count(DISTINCT canonical_id) FROM k) AS unique_count, (SELECT count(*) - count(DISTINCT canonical_id) FROM k) AS duplicate_count"),
    "target_carrier": _with("calls", "SELECT record, alt_index, CASE WHEN has THEN 'PENDING' ELSE 'UNSUPPORTED' END AS status, CASE WHEN NOT has THEN 'NOT_CARRIED_BY_TARGET' END AS error_code FROM calls WHERE member = 1"),
    "region_annotation": _with("ann", f"SELECT {_SPAN}, array_to_string(labels, ',') AS labels, array_to_string(gene_ids, ',') AS gene_ids FROM ann"),
    "region_primary": _with("ann", f"SELECT {_SPAN}, labels[1] AS primary_label, list_contains(labels, 'cds') AS is_coding, list_contains(labels, 'promoter') AS in_promoter FROM ann"),
    "region_routing": _with("ann cat", f"SELECT {_SPAN}, category FROM ann, cat WHERE {_RULE}"),
    "region_routing_counts": _with("ann cat", f"SELECT category, CAST(count(pos) AS BIGINT) AS n FROM (SELECT * FROM cat WHERE category <> 'intergenic') LEFT JOIN ann ON {_RULE} GROUP BY category"),
    "ccre_overlap": _with("s r", "SELECT s.chrom, s.pos, s.ref, arg_min('EH' || rid, (start_, end_, 'EH' || rid)) AS accession, arg_min(feature, (start_, end_, 'EH' || rid)) AS grp FROM s LEFT JOIN r ON r.chrom = s.chrom AND r.start_ <= s.v_end AND r.end_ >= s.pos GROUP BY ALL"),
    "in_peak": _with("s r", f"SELECT {_SPAN}, EXISTS (SELECT 1 FROM r WHERE feature = 'cds' AND r.chrom = s.chrom AND r.start_ <= s.v_end AND r.end_ >= s.pos) AS in_peak FROM s"),
    "nearest_genes": _with("near5", "SELECT chrom, pos, CAST(rank AS INTEGER) AS rank, gene_id, d * CASE WHEN pos < start_ THEN -1 ELSE 1 END AS signed_distance, min(d) OVER (PARTITION BY chrom, pos) <= 100000 AS within_100kb FROM near5 WHERE rank <= 5"),
    "range_fetch": _with("v r", "SELECT rid, string_agg(coalesce(CAST(x AS VARCHAR), 'nan'), ',' ORDER BY b.p) AS values FROM (SELECT rid, chrom, unnest(range(start_, end_ + 1)) AS p FROM r) b LEFT JOIN (SELECT chrom, pos, CAST(max(l_quantity) AS INTEGER) AS x FROM v GROUP BY ALL) t ON t.chrom = b.chrom AND t.pos = b.p GROUP BY rid"),
    "motif_hits": _with("r", "SELECT s_suppkey, coalesce(string_agg(feature, ',' ORDER BY feature), '') AS motifs FROM supplier LEFT JOIN (SELECT rid % 100 AS line, 1000 + rid * 7 % 120 AS a, 1000 + rid * 7 % 120 + (end_ - start_) // 20 AS b, feature FROM r WHERE (end_ - start_) // 20 >= 10) h ON line = s_suppkey % 100 AND ((a >= 1057 AND a <= 1057 + s_suppkey % 3) OR (b >= 1057 AND b <= 1057 + s_suppkey % 3) OR (a <= 1057 AND 1057 + s_suppkey % 3 <= b)) GROUP BY s_suppkey"),
    "score_lookup_left": _with("k am", f"SELECT {_KEYS}, canonical_id, transcript_id, score, class FROM k LEFT JOIN am ON k.chrom = am.chrom AND k.pos = am.pos AND k.ref = am.ref AND k.alt = am.alt"),
    "lookup_stats": _with("k am", "SELECT count(transcript_id) AS matched_rows, count(DISTINCT CASE WHEN transcript_id IS NOT NULL THEN canonical_id END) AS matched_variants, count(*) AS output_rows FROM k LEFT JOIN am ON k.chrom = am.chrom AND k.pos = am.pos AND k.ref = am.ref AND k.alt = am.alt"),
    "af_flatten": _with("freq", "SELECT * FROM freq"),
    "af_lookup": _with("freq", "SELECT c_custkey AS user_id, freq.user_id IS NOT NULL AS in_ot, " + ", ".join(f"coalesce(af_{m}, 0.0) AS af_{m}" for m in MODELS) + " FROM customer LEFT JOIN freq ON freq.user_id = c_custkey"),
    "snv_indel_lookup": _with("k am", "SELECT DISTINCT canonical_id, CASE WHEN length(k.ref) = 1 AND length(k.alt) = 1 THEN 'SNV' ELSE 'INDEL' END AS kind, score FROM k LEFT JOIN am ON k.chrom = am.chrom AND k.pos = am.pos AND k.ref = am.ref AND k.alt = am.alt AND transcript_id = 'T1'"),
    "resume_antijoin": _with("k am", "SELECT DISTINCT canonical_id FROM k WHERE NOT EXISTS (SELECT 1 FROM am WHERE k.chrom = am.chrom AND k.pos = am.pos AND k.ref = am.ref AND k.alt = am.alt)"),
    "derive_introns": _with("i", 'SELECT tx, a AS start, b AS "end" FROM i'),
    "derive_splice_sites": _with("sites", 'SELECT tx, kind, start, "end" FROM sites'),
    "derive_splice_regions": _with("zones", 'SELECT tx, side, start, "end" FROM zones'),
    "derive_promoters": _with("prom", 'SELECT gene_id, start, "end" FROM prom'),
    "region_table_union": _with("whole", "SELECT * FROM whole"),
    "feature_histogram": _with("whole", "SELECT feature, count(*) AS n FROM whole GROUP BY feature"),
    "gff_lookup": "SELECT 'T' || o_orderkey AS tx, 'G' || o_custkey AS gene_id, c_mktsegment AS biotype, CASE WHEN c_custkey % 7 = 0 THEN 'G' || c_custkey ELSE c_name END AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON c_custkey = o_custkey",
    "gff_regions": """
WITH gene AS (SELECT c_custkey AS g, 'G' || c_custkey AS gene_id, CASE WHEN c_custkey % 7 = 0 THEN 'G' || c_custkey ELSE c_name END AS gene_name, CASE WHEN c_custkey % 2 = 0 THEN 'protein_coding' ELSE 'lncRNA' END AS biotype,
  'chr' || (c_custkey % 22 + 1) AS chrom, c_custkey * 977 % 100000 + 1 AS a, c_custkey * 977 % 100000 + 5000 AS b, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM customer WHERE c_custkey % 5 <> 0),
part AS (SELECT l_orderkey AS tx, 'chr' || (l_orderkey % 22 + 1) AS chrom, l_partkey * 40 + l_linenumber AS a, l_partkey * 40 + l_linenumber + CAST(l_quantity AS BIGINT) AS b, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CASE l_linenumber % 5 WHEN 1 THEN 'cds' WHEN 3 THEN 'three_prime_utr' WHEN 4 THEN 'five_prime_utr' ELSE 'exon' END AS feature, 'G' || o_custkey AS gene_id, gene_name, biotype
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN gene ON g = o_custkey WHERE o_orderkey % 9 <> 0),
gap AS (SELECT chrom, strand, gene_id, gene_name, biotype, b AS last, n AS next, b + 1 AS a, n - 1 AS b FROM (SELECT *, lead(a) OVER (PARTITION BY tx ORDER BY a, b) AS n FROM part WHERE feature = 'exon') WHERE n > b + 1),
every AS (SELECT chrom, a AS "start", b AS "end", strand, feature, gene_id, gene_name, biotype FROM part
  UNION ALL SELECT chrom, a, b, strand, 'intron', gene_id, gene_name, biotype FROM gap
  UNION ALL SELECT chrom, a, least(a + 1, b), strand, CASE strand WHEN '+' THEN 'splice_donor' ELSE 'splice_acceptor' END, gene_id, gene_name, biotype FROM gap
  UNION ALL SELECT chrom, greatest(b - 1, a), b, strand, CASE strand WHEN '+' THEN 'splice_acceptor' ELSE 'splice_donor' END, gene_id, gene_name, biotype FROM gap
  UNION ALL SELECT chrom, last - 2, least(a + 7, b), strand, 'splice_region', gene_id, gene_name, biotype FROM gap
  UNION ALL SELECT chrom, greatest(b - 7, a), next + 2, strand, 'splice_region', gene_id, gene_name, biotype FROM gap
  UNION ALL SELECT chrom, greatest(CASE strand WHEN '+' THEN a - 500 ELSE b - 100 END, 1), CASE strand WHEN '+' THEN a + 100 ELSE b + 500 END, strand, 'promoter', gene_id, gene_name, biotype FROM gene)
SELECT * FROM every WHERE "end" >= "start"
""",
    "peaks_windows": _with("r", "SELECT variant, id, summit_pos, summit_pos - 1057 AS window_start, summit_pos + 1057 AS window_end FROM (SELECT 'summits' AS variant, rid AS id, start_ + rid % 50 AS summit_pos FROM r UNION ALL SELECT 'middles', rid, start_ + (end_ - start_) // 2 FROM r)"),
    "validate_variants": _with("valid", "SELECT id, error_code, CASE WHEN error_code IS NULL THEN 'PENDING' WHEN error_code = 'REF_MISMATCH' THEN 'REF_MISMATCH' ELSE 'FAILED' END AS status FROM valid"),
    "validation_summary": _with("valid", "SELECT CASE WHEN error_code IS NULL THEN 'PENDING' WHEN error_code = 'REF_MISMATCH' THEN 'REF_MISMATCH' ELSE 'FAILED' END AS status, error_code, count(*) AS n FROM valid GROUP BY ALL"),
    "allele_windows": _with(
        "sv",
        "SELECT id, rpad(left(repeat('N', CAST(greatest(33 - pos, 0) AS INTEGER)) || substring(n, greatest(pos - 32, 1), 64 - greatest(33 - pos, 0)), 64), 64, 'N') AS ref_seq, rpad(left(repeat('N', CAST(greatest(33 - pos, 0) AS INTEGER)) || substring(n, greatest(pos - 32, 1), pos - greatest(pos - 32, 1)) || alt2 || substring(n, pos + length(ref2), 64), 64), 64, 'N') AS alt_seq FROM (SELECT id, pos, regexp_replace(t, '[^ACGTN]', 'N', 'g') AS n, substring(t, pos, 2) AS ref2, CASE WHEN id % 3 = 0 THEN 'A' ELSE 'GATTACA' END AS alt2 FROM (SELECT *, translate(seq, 'acgtn', 'ACGTN') AS t FROM sv)) WHERE regexp_matches(ref2, '^[ACGTN]+$')",
    ),
    "alt_window": _with("w", "SELECT id, alt_seq, CAST(length(alt_seq) AS INTEGER) AS length FROM w"),
    "center_slice": _with("c", "SELECT 'sequence' AS kind, contig AS id, substring(seq, 76, 50) AS slice FROM c UNION ALL SELECT 'track', vec_id, array_to_string(list_transform(embedding[29:36], lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',') FROM embeddings"),
    "one_hot_counts": _with("c", "SELECT contig AS id, " + ", ".join(f"CAST(length(seq) - length(replace(seq, '{b}', '')) AS INTEGER) AS n_{b.lower()}" for b in "ACGT") + ", CAST(length(regexp_replace(seq, '[ACGT]', '', 'g')) AS INTEGER) AS n_other FROM c"),
    "peak_distribution": _with("dist", "SELECT i, value FROM dist"),
    "score_lfc": _with("sums", "SELECT vec_id, round((ys - xs) / ln(2), 6) AS lfc FROM sums"),
    "score_jsd": _with("jsd", "SELECT vec_id, round(jsd, 6) AS jsd FROM jsd"),
    "score_quantile": _with("quant", "SELECT vec_id, round(quantile, 6) AS quantile FROM quant"),
    "score_ips": _with("quant jsd", "SELECT vec_id, round((ys - xs) / ln(2) * jsd * quantile, 6) AS ips FROM quant JOIN jsd USING (vec_id)"),
    "profile_l1": _with("sums", "SELECT vec_id, round((ys - xs) / ln(2), 6) AS counts_log2fc, round(list_sum(list_transform(range(1, len(x) + 1), lambda k: abs(y[k] - x[k]))), 6) AS profile_l1 FROM sums"),
    "counts_profile": "SELECT vec_id, CAST(bin AS INTEGER) AS bin, round(exp(v - m) / s * exp(label % 3), 6) AS value FROM (SELECT *, max(v) OVER (PARTITION BY vec_id) AS m, sum(exp(v - mx)) OVER (PARTITION BY vec_id) AS s FROM (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS bin, CAST(list_max(embedding) AS DOUBLE) AS mx FROM embeddings))",
    "attribution_flatten": "SELECT vec_id, string_agg(letter, '' ORDER BY row_) AS sequence, round(sum(total), 6) AS contribution FROM (SELECT vec_id, row_, coalesce(min(CASE base WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END) FILTER (v <> 0), 'A') AS letter, sum(v) AS total FROM (SELECT vec_id, k // 4 AS row_, k % 4 AS base, CASE WHEN abs(x) < 0.05 THEN 0.0 ELSE CAST(x AS DOUBLE) END AS v FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings)) GROUP BY ALL) GROUP BY vec_id",
    "fold_average": _with("m", "SELECT user_id, CASE WHEN count(logfc) = 5 THEN round(avg(logfc), 6) END AS score, count(*) AS n_folds FROM m WHERE NOT (user_id % 10 = 0 AND model_id = 'view') GROUP BY user_id"),
    "fold_geomean": _with("m", "SELECT user_id, CASE WHEN count(*) = 5 THEN round(pow(product(logfc + 1), 0.2), 6) END AS pval_like FROM m GROUP BY user_id"),
    "fold_mean_skipnull": _with("m", "SELECT user_id, round(avg(CASE WHEN (user_id % 4 <> 0 OR model_id <> 'click') AND user_id % 15 <> 0 THEN logfc END), 6) AS mean FROM m GROUP BY user_id"),
    "fold_membership": _with(
        "m",
        "SELECT fold, side, user_id FROM (WITH x AS (SELECT model_id AS fold, user_id FROM m WHERE NOT (user_id % 7 = 0 AND model_id = 'view') AND NOT (user_id % 5 = 0 AND model_id = 'click')), f AS (SELECT DISTINCT fold FROM x WHERE fold <> 'click'), b AS (SELECT user_id FROM x WHERE fold = 'click') SELECT fold, 'missing' AS side, user_id FROM (SELECT fold, user_id FROM f, b EXCEPT SELECT fold, user_id FROM x) UNION ALL SELECT fold, 'extra', user_id FROM x WHERE fold <> 'click' AND user_id NOT IN (SELECT user_id FROM b))",
    ),
    "hypothetical_contributions": _with(
        "c",
        "SELECT id, position, " + ", ".join(f"CAST((position * 7 + {k * 3}) % 11 - 5 - under AS DOUBLE) AS {b}" for k, b in enumerate("acgt")) + ", CAST(CASE WHEN own > 0 THEN (position * 7 + (own - 1) * 3) % 11 - 5 - under ELSE 0 END AS DOUBLE) AS observed FROM ("
        "SELECT id, position, own, CASE WHEN back > 0 THEN (position * 7 + (back - 1) * 3) % 11 - 5 ELSE 0 END AS under FROM ("
        "SELECT contig AS id, CAST(k AS INTEGER) AS position, strpos('ACGT', substring(w, k + 1, 1)) AS own, strpos('ACGT', substring(w, 24 - k, 1)) AS back FROM (SELECT contig, regexp_replace(substring(seq, 1, 24), '[^ACGT]', 'N', 'g') AS w FROM c WHERE length(seq) >= 24), range(24) t(k)))",
    ),
    "array_fold_mean": "SELECT label, CAST(bin AS INTEGER) AS bin, round(avg(v), 6) AS mean FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) - 1 AS bin FROM embeddings) GROUP BY ALL",
    "score_pivot": _with("m", f"SELECT user_id, {_PIVOT} FROM m GROUP BY user_id"),
    "prioritize": _with("flag", "SELECT user_id, " + ", ".join(f"bool_or(pri) FILTER (model_id = '{m}') AS prioritized_{m}" for m in MODELS) + ", bool_or(pri) AS prioritized FROM flag GROUP BY user_id"),
    "top_model": _with("flag", "SELECT user_id, model_id AS top_model, round(logfc, 6) AS top_logfc FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN any_ AND NOT pri THEN 0 ELSE abs(logfc) END DESC, model_id) AS k FROM (SELECT *, bool_or(pri) OVER (PARTITION BY user_id) AS any_ FROM flag)) WHERE k = 1"),
    "max_abs_score": _with("m", "SELECT user_id, round(max(abs(logfc)) FILTER (user_id % 6 <> 0 OR model_id <> 'click'), 6) AS max_abs FROM m GROUP BY user_id"),
    "pedigree_relationships": "WITH p AS (SELECT c_custkey AS k, c_custkey // 10 * 10 AS f, c_custkey % 10 AS d FROM customer) SELECT CAST(k AS VARCHAR) AS person, CASE WHEN f + 5 NOT IN (SELECT k FROM p) THEN 'RELATIVE' WHEN d = 5 THEN 'PROBAND' WHEN f = 0 AND d <> 1 THEN 'RELATIVE' WHEN d = 0 THEN 'MOTHER' WHEN d = 1 THEN 'FATHER' WHEN d BETWEEN 4 AND 8 THEN 'SIBLING' ELSE 'RELATIVE' END AS relationship FROM p",
    "classify_inheritance": _with("inh", "SELECT record, alt_index, inheritance FROM inh"),
    "family_evidence": _with("inh carried", "SELECT record, alt_index, " + ", ".join(f"max({x}) FILTER (member = {k}) AS {r}_{y}" for k, r in ((1, "proband"), (2, "mother"), (3, "father")) for x, y in (("txt", "gt"), ("dp", "dp"), ("gq", "gq"))) + ", any_value(inheritance) AS inheritance FROM calls JOIN carried USING (record, alt_index) JOIN inh USING (record, alt_index) GROUP BY record, alt_index"),
    "family_carriers": _with("carried", "SELECT record, alt_index, coalesce(string_agg(who, ',' ORDER BY member) FILTER (has AND member IN (1, 4)), '') AS affected_carriers, coalesce(string_agg(who, ',' ORDER BY member) FILTER (has AND member IN (2, 3)), '') AS unaffected_carriers, coalesce(string_agg(who, ',') FILTER (has AND member = 4), '') AS shared_siblings FROM calls JOIN carried USING (record, alt_index) GROUP BY ALL"),
    "family_quality_flags": _with("carried", "SELECT record, alt_index, coalesce(string_agg(flag, ',' ORDER BY member, place), '') AS quality_flags FROM (SELECT record, alt_index, member, who, has, unnest([1, 2]) AS place, unnest([CASE WHEN dp < 10 THEN who || ':LOW_DP' END, CASE WHEN gq < 20 THEN who || ':LOW_GQ' END]) AS flag0, CASE WHEN has THEN flag0 END AS flag FROM calls) JOIN carried USING (record, alt_index) GROUP BY ALL"),
    "format_gt": _with("fam", "SELECT record, member, CASE WHEN gt IS NULL THEN './.' WHEN phased THEN array_to_string(gt, '|') ELSE array_to_string(gt, '/') END AS gt_text FROM fam"),
    "augment_status": _with("aug", "SELECT record_ordinal, CAST(alt_index AS INTEGER) AS alt_index, status FROM aug"),
    "augment_merge": _with("aug", "SELECT record_ordinal, CAST(alt_index AS INTEGER) AS alt_index, alt, error_code, result_variant_id, score, gene FROM aug"),
    "augment_misalignment": _with("aug", "SELECT 'missing_result' AS side, record_ordinal, CAST(alt_index AS INTEGER) AS alt_index FROM aug WHERE result_variant_id IS NULL"),
    "augment_info_arrays": _with("aug", "SELECT record_ordinal, " + ", ".join(f"CASE WHEN count({c}) > 0 THEN string_agg(coalesce({c}, '.'), ',' ORDER BY alt_index) END AS {n}" for c, n in (("status", "statuses"), ("error_code", "errors"), ("gene", "genes"))) + " FROM aug GROUP BY record_ordinal"),
    "model_score_entries": _with("flag", f"SELECT user_id, coalesce(string_agg({_ENTRY}, ',' ORDER BY nr) FILTER (user_id % 9 <> nr), '') AS entries FROM (SELECT *, list_position(['click', 'error', 'purchase', 'signup', 'view'], model_id) AS nr FROM flag) GROUP BY user_id"),
    "json_first_gene": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'S' WHEN 2 THEN 'N' ELSE 'plain ' END || json_extract_string(props, '$.k') AS first FROM events",
    "motif_name": "SELECT p_partkey, regexp_extract('pos_patterns.' || replace(p_name, ' ', '_') || '#' || p_partkey % 9 || '_' || p_size, 'patterns\\.(.*)_[^_]*$', 1) AS name FROM part",
    "union_missing_cols": "SELECT r_regionkey, r_name AS name, NULL::INTEGER AS n_nationkey, NULL::INTEGER AS n_regionkey FROM region UNION ALL SELECT NULL, n_name, n_nationkey, n_regionkey FROM nation",
    "content_sha": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
}
