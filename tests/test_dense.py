"""Dense intervals: what a variant meets does not grow with how many intervals lie over it."""

import random

import pytest
from pyspark.sql import functions as F

from genoframe.operators import intervals, motifs, regions

SPANS = "chrom string, pos long, ref string"
PLACES = "chrom string, start long, end long"


def spans(spark, n, seed):
    rng = random.Random(seed)
    rows = {("c%d" % rng.randrange(3), rng.randrange(1, 6000), "A" * rng.choice([1, 3, 1500])) for _ in range(n)}
    return rows, spark.createDataFrame(sorted(rows), SPANS).withColumn("v_end", F.col("pos") + F.length("ref") - 1)


def places(n, seed):
    rng = random.Random(seed)
    return [("c%d" % rng.randrange(2), a := rng.randrange(1, 5000), a + rng.choice([-2, 0, 10, 900, 2500])) for _ in range(n)]


@pytest.mark.parametrize("beyond", [0, 1 << 40])
def test_labels_of_dense_regions(spark, beyond):
    rng = random.Random(2)
    kinds = [("exon", "protein_coding"), ("exon", "lncRNA"), ("cds", "a"), ("cds", "b"), ("splice_donor", "a"), ("intron", None), ("odd", "a")]
    rows = [(*p, *rng.choice(kinds), rng.choice(["G1", "G2", None])) for p in places(150, 1)] + [("c9", 1, 1 + beyond, "promoter", "a", "G9")]
    table = spark.createDataFrame(rows, PLACES + ", feature string, biotype string, gene_id string")
    _, left = spans(spark, 200, 3)
    left = left.unionByName(left.where("pos < 900").limit(1).withColumn("chrom", F.lit("c9")))
    got = regions.annotate(left, table).collect()
    label = lambda f, b: {"exon": ["exonic" if b == "protein_coding" else "noncoding_gene"], "splice_donor": ["splice_site", "splice_region"], "intron": ["intronic"]}.get(f, [f])
    assert len(got) == left.count()
    for r in got:
        met = [x for x in rows if x[0] == r.chrom and x[1] <= x[2] and x[1] <= r.pos + len(r.ref) - 1 and x[2] >= r.pos]
        found = {y for x in met for y in label(x[3], x[4])}
        assert r.labels == ([x for x in regions.SEVERITY if x in found] or ["intergenic"])
        assert r.gene_ids == sorted({x[5] for x in met if x[5]})


def test_condensed_regions_do_not_grow_with_copies(spark):
    one = spark.range(200).selectExpr("'c' AS chrom", "id * 10 AS start", "id * 10 + 40 AS end", "'cds' AS feature", "'x' AS biotype", "concat('G', id % 3) AS gene_id")
    many = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(29)))).withColumn("end", F.col("end") + F.col("i")).drop("i")
    assert regions.condensed(many).count() <= regions.condensed(one).count() + 3 <= 20


def test_first_of_dense_overlaps_is_brute_force(spark):
    rows = [(*p, f"E{k % 40:02d}") for k, p in enumerate(places(300, 4))]
    wanted, left = spans(spark, 300, 5)
    e = spark.createDataFrame(rows, PLACES + ", accession string")
    key, on = ["chrom", "pos", "ref"], ("chrom", "pos", "v_end")
    got = {(r.chrom, r.pos, r.ref): (r.accession, r.start) for r in intervals.first_overlap(left, e, key, ["accession", "start"], ["start", "end", "accession"], on, ("chrom", "start", "end")).collect()}
    has = {(r.chrom, r.pos, r.ref): r.x for r in intervals.overlaps_any(left, e, key, "x", on).collect()}
    assert got.keys() == has.keys() == wanted
    for c, p, ref in wanted:
        best = min(((s, n, a) for g, s, n, a in rows if g == c and s <= n and s <= p + len(ref) - 1 and n >= p), default=None)
        assert got[c, p, ref] == ((best[2], best[0]) if best else (None, None)) and has[c, p, ref] == (best is not None)
    # a span meets one candidate, however many intervals lie over it
    assert intervals._first_or_none(left, e, [], ["start", "end"], on, ("chrom", "start", "end")).count() == len(wanted)
    with pytest.raises(ValueError, match="start"):
        intervals.first_overlap(left, e, key, ["accession"], ["accession"], on, ("chrom", "start", "end"))


def test_variants_of_one_window_share_its_list(spark):
    hits = spark.createDataFrame([(w, s, s + 30, f"M{s % 7}") for w in (0, 1) for s in range(1000, 1080, 3)], "w int, start int, end int, motif string")
    rows = [(k, k % 3, 1 + k % 4) for k in range(60)] + [(7, 0, 3), (7, 2, 1), (8, None, 1), (None, 1, 2)]
    v = spark.createDataFrame(rows, "k int, w int, size int")
    found = motifs.overlapping(v, hits, ["k"], ["w"], F.col("size"))
    of = lambda w, size: [f"M{s % 7}" for s in range(1000, 1080, 3) if w in (0, 1) and s <= 1057 + size - 1 and s + 30 >= 1057]
    wanted = {key: sorted(m for k, w, size in rows if k == key for m in of(w, size)) for key, _, _ in rows}
    assert {r.k: r.motifs for r in found.collect()} == wanted
    # rows with lists are not grouped: no aggregate or exchange stands above the join of those that are alone
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Aggregate")


def test_values_per_base_are_cut_from_chunks(spark):
    rng = random.Random(8)
    track = {("c%d" % rng.randrange(2), rng.randrange(0, 9000)): rng.randrange(99) for _ in range(900)}
    rows = [(k, "c%d" % (k % 3), a := rng.randrange(0, 9000), a + n) for k, n in enumerate([0, 1, 500, 1023, 1024, 1500, 2047, 2048, 3000, 7000] * 4)] + [(99, None, 1, 3), (98, "c0", 5, 4), (0, "c0", 1, 3), (0, "c0", 1, 3)]
    r = spark.createDataFrame(rows, "id int, chrom string, start long, end long")
    t = spark.createDataFrame([(*k, v) for k, v in track.items()], "chrom string, pos long, value int")
    out = intervals.per_base(r, t)
    wanted = sorted(((k, [track.get((c, p)) for p in range(a, b + 1)]) for k, c, a, b in set(rows) if a <= b), key=str)
    assert sorted(((x.id, x["values"]) for x in out.collect()), key=str) == wanted
    # regions meet chunks by keys alone: no row stands for a pair of region and base
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert joins and not any("<=" in x for x in joins)
