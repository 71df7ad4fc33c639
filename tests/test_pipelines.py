import json
import zlib

import pytest
from pyspark.sql import functions as F

from genoframe import cli
from genoframe.operators import inference
from genoframe.plans import jobs, pipelines
from genoframe.sources import readers, sinks

REGION = "chrom string, start long, end long, feature string, biotype string, gene_id string"


def lines(path, *rows):
    path.write_text("\n".join(rows) + "\n")
    return str(path)


def test_preprocess_with_a_family(spark, tmp_path):
    fasta = lines(tmp_path / "g.fa", ">chr1", *["ACGT" * 25] * 2)
    vcf = lines(
        tmp_path / "f.vcf", "##fileformat=VCFv4.2", "##contig=<ID=chr1>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSp\tSm\tSf",
        "chr1\t101\trs\tA\tC,G\t.\t.\tAC=3,1;AN=6;AF=0.5,0.1\tGT:AD:DP:GQ\t0/1:5,6:11:30\t0/1:2,2:4:50\t0/0:9:20:40", "chr1\t102\t.\tA\tC\t.\t.\t.\tGT\t0/1\t0/0\t0/0", "chr1\t103\t.\tG\t*\t.\t.\t.\tGT\t0/1\t0/0\t0/0",
    )
    packet = {"id": "F", "proband": {"subject": {"id": "p"}}, "pedigree": {"persons": [{"individualId": "p", "maternalId": "m", "paternalId": "f", "affectedStatus": "AFFECTED"}, {"individualId": "m", "affectedStatus": "UNAFFECTED"}, {"individualId": "f", "affectedStatus": "UNAFFECTED"}]}, "files": [{"uri": "f.vcf", "individualToFileIdentifiers": {"p": "Sp", "m": "Sm", "f": "Sf"}}]}
    family = lines(tmp_path / "p.json", json.dumps(packet))
    spark.createDataFrame([("chr1", 90, 110, "cds", "protein_coding", "G")], REGION).write.parquet(str(tmp_path / "r"))
    out = str(tmp_path / "out")
    cli.main(["preprocess", vcf, fasta, str(tmp_path / "r"), out, "--width", "20", "--phenopacket", family], spark)
    m = sinks.read_manifest(spark, f"{out}/manifest.json")
    assert [m[k] for k in ("record_count", "alt_occurrence_count", "valid_occurrence_count", "invalid_occurrence_count", "unsupported_occurrence_count", "target_excluded_occurrence_count", "unique_canonical_variants")] == [3, 4, 1, 1, 2, 1, 1]
    assert m["categories"]["coding"] == 1 and m["categories"]["promoter"] == 0
    rows = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/family").where("pos = 101").collect()
    assert [(r.alt, r.inheritance, r.cohort_ac, r.proband_ad, r.quality_flags) for r in rows] == [("C", "MATERNAL", "3", "5,6", "m:LOW_DP")]
    again = pipelines.preprocess(spark, vcf, fasta, spark.read.parquet(str(tmp_path / "r")), out, width=20, phenopacket=family)
    assert again["fingerprint"] == m["fingerprint"]
    with pytest.raises(ValueError, match="VCF"):
        pipelines.preprocess(spark, lines(tmp_path / "x.tsv", "chr1\t1\tA\tC"), fasta, None, out, phenopacket=family)


def test_annotate(spark, tmp_path):
    table = spark.createDataFrame([("chr1", 90, 110, "cds", "protein_coding", "G1")], REGION)
    genes = spark.createDataFrame([("chr1", 90, 110, "N1", "G1"), ("chr1", 500_000, 600_000, "N2", "G2")], "chrom string, start long, end long, gene_name string, gene_id string")
    elements = spark.createDataFrame([("chr1", 100, 105, "E1", "PLS")], "chrom string, start long, end long, accession string, grp string")
    af = spark.createDataFrame([("1", 101, "A", "T", [("afr_adj", 0.25), ("nfe_adj", None)])], "chrom string, pos long, ref string, alt string, frequencies array<struct<population:string,frequency:double>>")
    v = readers.read_tsv(spark, lines(tmp_path / "v.tsv", "chr1\t101\tA\tT\tid", "chr1\t900000\tAC\tA\t", "chr9\t5\tA\tG\t"))
    got = {r.pos: r for r in pipelines.annotate(v, table, genes, elements, af).collect()}
    a, b, c = got[101], got[900000], got[5]
    assert len(a) == 29 and (a.region_type, a.is_coding, a.ccre_id, a.ccre_group, a.in_ot, a.af_afr, a.af_nfe, a.variant_type) == ("cds", True, "E1", "PLS", True, 0.25, 0.0, "SNV")
    assert [(g.gene_id, g.distance) for g in a.nearest_genes] == [("G1", 0), ("G2", -499_899)] and a.gene_within_100kb
    assert (b.region_type, b.variant_id, b.variant_type, b.in_ot, b.gene_within_100kb) == ("intergenic", None, "deletion", False, False)
    assert c.nearest_genes == [] and c.region_labels == ["intergenic"]


def test_scores_from_a_model(spark):
    contigs = spark.createDataFrame([("chr1", "ACGT" * 10)], "contig string, seq string")
    v = spark.createDataFrame([("chr1", 21, "A", "C"), ("chr1", 21, "G", "C"), ("chr2", 1, "A", "C")], "chrom string, pos long, ref string, alt string")

    def load():
        return lambda seqs: ([[float(s.count(b)) for b in "ACGT"] for s in seqs], [float(s.count("C")) for s in seqs])

    windows = inference.with_windows(v, contigs, 8)
    assert sorted(r.window_error or "" for r in windows.collect()) == ["", "INVALID_CHROMOSOME", "REF_MISMATCH"]
    dist = spark.range(1000).select((F.col("id") / 250.0).alias("value"))
    peaks = spark.createDataFrame([("chr1", 21, 30)], "chrom string, start long, end long")
    r = pipelines.score(inference.predict(windows, load, 1), dist, peaks).first()
    assert r.ref_logcounts == 2.0 and r.alt_logcounts == 3.0 and r.lfc == pytest.approx(1 / 0.6931471805599453) and r.active_allele_quantile == 0.75 and r.in_peak and 0 < r.jsd < 1


def test_folds_and_priorities(spark, tmp_path):
    head = "variant_id\tcounts_log2fc\tprofile_l1"
    paths = [lines(tmp_path / f"f{k}.tsv", head, f"a\t{k}\t", f"b\t\t{k}") for k in range(2)]
    cli.main(["summarize", "-f", paths[0], "-f", paths[1], str(tmp_path / "s")], spark)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s")).collect()) == ["a\t0.5\t", "b\t\t0.5", head]
    with pytest.raises(ValueError, match="fold 1"):
        pipelines.summarize_folds(spark, [paths[0], lines(tmp_path / "g.tsv", head, "a\t1\t1")])
    mean = pipelines.average_folds(spark, [lines(tmp_path / f"p{k}.tsv", "chr\tpos\tlfc\tjsd_pval", f"c\t5\t{k}\t{2 ** k}") for k in range(3)], ["chr", "pos"], ["lfc", "jsd_pval"]).first()
    assert (mean.lfc, mean.jsd_pval) == (1.0, pytest.approx(2.0))
    s = "variant_id string, chr string, pos long, ref string, alt string, region_type string, in_promoter boolean, model_id string, logfc double, active_allele_quantile double, in_peak boolean"
    rows = [("v", "c", 1, "A", "T", "promoter", True, m, x, 0.5, False) for m, x in (("a", -0.3), ("b", 0.1))]
    r = pipelines.prioritize_variants(spark.createDataFrame(rows, s), ["a", "b"]).first()
    assert (r.prioritized, r.prioritized_b, r.top_model, r.top_logfc) == (True, False, "a", -0.3)


GFF = [
    "##gff-version 3", "1\te\tgene\t101\t400\t.\t+\t.\tID=gene:G1;Name=N1;biotype=protein_coding", "1\te\tmRNA\t101\t400\t.\t+\t.\tID=transcript:T1;Parent=gene:G1;biotype=nonsense",
    "1\te\texon\t101\t150\t.\t+\t.\tParent=transcript:T1", "1\te\texon\t301\t400\t.\t+\t.\tParent=transcript:T1", "1\te\tfive_prime_UTR\t101\t109\t.\t+\t.\tParent=transcript:T1",
    "1\te\tCDS\t110\t150\t.\t+\t0\tID=CDS:P1;Parent=transcript:T1", "1\te\tCDS\t301\t350\t.\t+\t1\tID=CDS:P1;Parent=transcript:T1", "1\te\tthree_prime_UTR\t351\t400\t.\t+\t.\tParent=transcript:T1",
    "1\te\tncRNA_gene\t700\t900\t.\t-\t.\tID=gene:G2;biotype=lncRNA", "1\te\tlnc_RNA\t700\t900\t.\t-\t.\tID=transcript:T2;Parent=gene:G2", "1\te\texon\t700\t900\t.\t-\t.\tParent=transcript:T2", "1\te\texon\t5\t9\t.\t-\t.\tParent=transcript:none", "KI\te\tgene\t1\t2\t.\t+\t.\tID=gene:G9",
]


def test_region_table_feeds_annotation_and_preprocessing(spark, tmp_path):
    gff = lines(tmp_path / "a.gff3", *GFF)
    cli.main(["regions", gff, str(tmp_path / "t")], spark)
    cli.main(["genes", gff, str(tmp_path / "g")], spark)
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.columns == ["chrom", "start", "end", "strand", "feature", "gene_id", "gene_name", "biotype"]
    got = {r.feature: r.n for r in table.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    assert got == {"exon": 3, "cds": 2, "five_prime_utr": 1, "three_prime_utr": 1, "intron": 1, "splice_donor": 1, "splice_acceptor": 1, "splice_region": 2, "promoter": 2}
    assert {(r.gene_id, r.gene_name, r.biotype) for r in table.select("gene_id", "gene_name", "biotype").distinct().collect()} == {("G1", "N1", "protein_coding"), ("G2", "G2", "lncRNA")}
    assert {(r.start, r.end) for r in table.where("feature = 'promoter'").collect()} == {(1, 201), (800, 1400)}
    ccre = lines(tmp_path / "c.bed", "chr1\t100\t105\tE1\tr\tPLS")
    cli.main(["elements", ccre, str(tmp_path / "e")], spark)
    spark.createDataFrame([("1", 120, "A", "T", [("afr_adj", 0.12345), ("nfe_adj", None), (None, 0.5)])], "chromosome string, position int, referenceAllele string, alternateAllele string, alleleFrequencies array<struct<populationName:string,alleleFrequency:double>>").write.parquet(str(tmp_path / "raw"))
    cli.main(["frequencies", str(tmp_path / "raw"), str(tmp_path / "f")], spark)
    v = lines(tmp_path / "v.tsv", "chr1\t120\tA\tT\tx", "chr1\t149\tACC\tA\ty", "chr1\t360\tA\tG\tz", "chr1\t800\tA\tG\tw", "chr1\t5000\tA\tG\tu")
    cli.main(["annotate", v, *[str(tmp_path / x) for x in "tgef"], str(tmp_path / "out")], spark)
    rows = {r.variant_id: r for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert (rows["x"].region_type, rows["x"].is_coding, rows["x"].in_promoter, rows["x"].in_ot, rows["x"].af_afr, rows["x"].af_nfe) == ("cds", True, True, True, 0.123, 0.0)
    assert rows["y"].region_type == "splice_site" and {"cds", "splice_region", "intronic", "exonic"} <= set(rows["y"].region_labels)
    assert (rows["z"].region_type, rows["w"].region_type, rows["u"].region_type) == ("three_prime_utr", "noncoding_gene", "intergenic") and rows["w"].region_gene_ids == ["G2"]
    assert [g.gene_name for g in rows["w"].nearest_genes] == ["G2", "N1"]
    fasta = lines(tmp_path / "g.fa", ">chr1", "A" * 6000)
    tsv = lines(tmp_path / "p.tsv", "chr1\t120\tA\tT\tx", "chr1\t360\tA\tG\tz", "chr1\t5000\tA\tG\tu")
    cli.main(["preprocess", tsv, fasta, str(tmp_path / "t"), str(tmp_path / "pre"), "--width", "20"], spark)
    counts = sinks.read_manifest(spark, str(tmp_path / "pre/manifest.json"))["categories"]
    assert (counts["coding"], counts["three_prime_utr"], counts["promoter"], counts["splice"]) == (1, 1, 1, 0)
    import genoframe

    one = genoframe.annotate_variant("chr1", 120, "A", "T", *[spark.read.parquet(str(tmp_path / x)) for x in "tgef"])
    assert one["region_type"] == "cds" and all(hasattr(genoframe, name) for name in genoframe.__all__)


def load_model():
    return lambda seqs: ([[float(s.count(b)) for b in "ACGT"] for s in seqs], [float(s.count("C")) for s in seqs])


def test_score_jobs_go_on_where_they_stopped(spark, tmp_path):
    from genoframe.operators import inference
    from genoframe.plans import jobs

    fasta = lines(tmp_path / "g.fa", ">chr1", "ACGT" * 50)
    v = lines(tmp_path / "v.tsv", *[f"chr1\t{p}\t{'ACGT'[(p - 1) % 4]}\tGG\tv{p}" for p in range(40, 60)], "chr1\t41\tG\tC\tbad")
    spark.range(1000).select((F.col("id") / 250.0).alias("value")).write.parquet(str(tmp_path / "d"))
    args = ["score", v, fasta, str(tmp_path / "d"), "tests.test_pipelines:load_model", str(tmp_path / "s"), "--width", "8", "--buckets", "3"]
    cli.main(args, spark)
    rows = spark.read.parquet(str(tmp_path / "s"))
    assert rows.count() == 20 and {"lfc", "jsd", "active_allele_quantile", "ips", "bucket"} <= set(rows.columns)
    import shutil

    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")}
    (tmp_path / "s/_bucket-1.json").unlink()
    shutil.rmtree(tmp_path / "s/bucket=1")
    cli.main(args, spark)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 20 and all(p.stat().st_mtime_ns == t for p, t in before.items() if "bucket=1" not in str(p))
    cli.main(["predict", v, fasta, str(tmp_path / "p"), "-m", "a=tests.test_pipelines:load_model", "-m", "b=tests.test_pipelines:load_model", "--width", "8"], spark)
    assert {(r.fold, r.n) for r in spark.read.parquet(str(tmp_path / "p")).groupBy("fold").agg(F.count("*").alias("n")).collect()} == {("a", 20), ("b", 20)}
    table = readers.read_variants(spark, v)
    work = lambda df: df.select("canonical_id", F.lit(1.0).alias("s"))
    done = str(tmp_path / "done")
    assert (jobs.append_scores(table.limit(5), done, work), jobs.append_scores(table, done, work), jobs.append_scores(table, done, work)) == (5, 16, 0)
    explain = lambda: lambda seq, shuffled: [sum(s[k] == x for s in shuffled) for k, x in enumerate(seq)]
    assert jobs.attribute_variants(table, readers.read_fasta_chunks(spark, fasta), explain, str(tmp_path / "a"), "m", 8, 4, 2) == 2
    r = spark.read.parquet(str(tmp_path / "a")).first()
    assert len(r.ref_attributions) == 8 and r.ref_attributions[0] == 4.0 and inference is not None


def variants_of(spark, n):
    return spark.range(n).selectExpr("'chr1' AS chr", "id + 1 AS pos", "'A' AS ref", "'C' AS alt")


def test_repeated_keys_are_appended_once(spark, tmp_path):
    rows = variants_of(spark, 6)
    work = lambda df: df.select("canonical_id", F.lit(1.0).alias("s"))
    ran = [jobs.append_scores(x, str(tmp_path / "d"), work) for x in (rows.limit(2).unionByName(rows.limit(2)), rows.unionByName(rows), rows)]
    assert ran == [2, 4, 0] and spark.read.parquet(str(tmp_path / "d")).count() == 6


def test_buckets_of_another_plan_go(spark, tmp_path):
    """Of 64 buckets, then 32, 2 and 4, each leaves the rows once."""
    out = str(tmp_path / "b")
    work = lambda df: df.select("canonical_id", F.lit(1.0).alias("s"))
    for buckets in (64, 32, 2, 4):
        assert jobs.in_buckets(variants_of(spark, 100), work, out, "m", buckets) == buckets
        rows = spark.read.parquet(out)
        assert rows.count() == rows.select("canonical_id").distinct().count() == 100
    assert jobs.in_buckets(variants_of(spark, 100), work, out, "m", 4) == 0 and jobs.in_buckets(variants_of(spark, 100), work, out, "n", 4) == 4


def test_only_what_is_missing_or_damaged_is_written(spark, tmp_path):
    out = tmp_path / "b"
    asked = []

    def work(df):
        asked.append(sorted(r.b for r in df.selectExpr("pmod(xxhash64(canonical_id), 8) AS b").distinct().collect()))
        return df.select("canonical_id", F.lit(1.0).alias("s"))

    run = lambda **more: jobs.in_buckets(variants_of(spark, 200), work, str(out), "m", 8, **more)
    assert run(at_once=3) == 8 and asked == [[0, 1, 2], [3, 4, 5], [6, 7]]
    wanted = sorted(tuple(r) for r in spark.read.parquet(str(out)).select("canonical_id", "bucket").collect())
    (part,) = (out / "bucket=3").glob("part-*")
    whole = part.read_bytes()
    part.write_bytes(whole[: len(whole) // 2] + b"x" * 9)
    (out / "bucket=3" / f".{part.name}.crc").unlink(missing_ok=True)
    for f in (out / "bucket=5").iterdir():
        f.unlink()
    (out / "bucket=11").mkdir()
    (out / "bucket=11" / "part-0.parquet").write_bytes(whole)
    del asked[:]
    assert run() == 2 and asked == [[3, 5]] and not (out / "bucket=11").exists()
    assert sorted(tuple(r) for r in spark.read.parquet(str(out)).select("canonical_id", "bucket").collect()) == wanted
    assert run() == 0


def test_a_stopped_run_goes_on(spark, tmp_path):
    out, calls = str(tmp_path / "b"), []

    def work(df):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("stopped")
        return df.select("canonical_id", F.lit(1.0).alias("s"))

    run = lambda: jobs.in_buckets(variants_of(spark, 200), work, out, "m", 8, at_once=2)
    with pytest.raises(OSError):
        run()
    assert run() == 4 and spark.read.parquet(out).count() == 200


def test_empty_buckets_are_complete(spark, tmp_path):
    out = str(tmp_path / "b")
    work = lambda df: df.select("canonical_id", F.lit(1.0).alias("s"))
    assert jobs.in_buckets(variants_of(spark, 1), work, out, "m", 16) == 16 and jobs.in_buckets(variants_of(spark, 1), work, out, "m", 16) == 0
    assert jobs.in_buckets(variants_of(spark, 0), work, str(tmp_path / "c"), "m", 3) == 3 and jobs.in_buckets(variants_of(spark, 0), work, str(tmp_path / "c"), "m", 3) == 0


def test_digests_of_texts_know_every_line_and_its_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "LINE_BLOCK", 7)
    rows = [f"line {k}" for k in range(50)]
    digest = lambda name, x: readers.text_digest(spark, lines(tmp_path / name, *x))
    first = digest("a", rows)
    assert first == digest("b", rows) and first[1] == (tmp_path / "a").stat().st_size
    assert len({digest("c", x)[0] for x in (rows, rows[::-1], rows[:-1], [*rows[:-1], "other"], [rows[1], rows[0], *rows[2:]])}) == 5


def test_another_genome_is_validated_anew(spark, tmp_path):
    table = lines(tmp_path / "v.tsv", "chr1\t50\tC\tT\trs")
    spark.createDataFrame([("chr1", 1, 9, "cds", "protein_coding", "G")], REGION).write.parquet(str(tmp_path / "r"))
    counts = []
    for letters in ("ACGT" * 25, "TTTT" * 26):
        fasta = lines(tmp_path / "g.fa", ">chr1", letters)
        counts.append(pipelines.preprocess(spark, table, fasta, spark.read.parquet(str(tmp_path / "r")), str(tmp_path / "out"), width=8)["valid_occurrence_count"])
    assert counts == [1, 0]


def test_hypothetical_contributions_are_the_definition():
    import numpy as np

    rng = np.random.default_rng(3)
    seqs = ["ACGTN", "TTAAC"]
    backgrounds = inference.encoded(["CCGTA", "NNNNN", "GATCA"] * 2).reshape(2, 3, 5, 4)
    multipliers = rng.normal(size=backgrounds.shape)
    want = np.zeros((2, 5, 4))
    for n in range(2):
        for at in range(5):
            for base in range(4):
                for b in range(3):
                    for c in range(4):
                        want[n, at, base] += ((c == base) - backgrounds[n, b, at, c]) * multipliers[n, b, at, c] / 3
    assert np.allclose(inference.hypothetical(multipliers, backgrounds), want)
    assert inference.encoded(seqs).sum(-1).tolist() == [[1, 1, 1, 1, 0], [1] * 5] and inference.encoded(["acgt"]).tolist() == inference.encoded(["ACGT"]).tolist()


def test_contributions_of_a_linear_model_add_up(spark, tmp_path):
    """For f(x) = sum of w x the observed contributions sum to f(sequence) less the mean of f over the backgrounds."""
    import numpy as np

    fasta = lines(tmp_path / "g.fa", ">chr1", "ACGTTGCA" * 30)
    table = spark.createDataFrame([("chr1", 101 + 8 * k, "T", "C", str(k)) for k in range(5)], "chr string, pos long, ref string, alt string, variant_id string")
    weights = np.random.default_rng(1).normal(size=(16, 4))
    load = lambda: lambda own, backgrounds: np.broadcast_to(weights, backgrounds.shape)
    out = str(tmp_path / "c")
    made = lambda: jobs.contribute_variants(table, readers.read_fasta_chunks(spark, fasta), load, out, "m", 16, 4, 2, 3)
    assert made() == 3 and made() == 0
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 5
    for r in rows:
        for seq, observed, four in ((r.ref_seq, r.ref_observed, r.ref_hypothetical), (r.alt_seq, r.alt_observed, r.alt_hypothetical)):
            rng = np.random.default_rng([0, zlib.crc32(seq.encode())])
            others = [inference.dinucleotide_shuffle(seq, rng) for _ in range(4)]
            value = lambda s: (inference.encoded([s])[0] * weights).sum()
            assert abs(sum(observed) - (value(seq) - np.mean([value(o) for o in others]))) < 1e-6
            assert np.allclose([four[k]["ACGT".index(b)] for k, b in enumerate(seq)], observed)


def test_dinucleotide_shuffle_keeps_pairs():
    from collections import Counter

    import numpy as np

    rng = np.random.default_rng(1)
    seen = set()
    for seq in ("ACGT" * 20 + "AACCGGTT" * 5, "A", "AC", "AAAA", "ACACACAG", "NACGTTN"):
        for _ in range(30):
            got = inference.dinucleotide_shuffle(seq, rng)
            assert Counter(zip(got, got[1:])) == Counter(zip(seq, seq[1:])) and got[:1] == seq[:1] and got[-1:] == seq[-1:]
            seen.add(got)
    assert len(seen) > 25


def test_export(spark, tmp_path):
    from genoframe.operators import augment

    vcf = lines(tmp_path / "s.vcf", "##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "chr1\t5\trs\tA\tC,G\t.\tPASS\tDB", "chr1\t9\t.\tT\t*\t.\tPASS\t.")
    digest, _ = readers.text_digest(spark, str(tmp_path / "s.vcf"))
    schema = "record_ordinal long, alt_index int, status string, error_code string, result_variant_id string, prioritized boolean, most_active_celltype string, region_type string, nearest_genes string, liv_logfc double, liv_in_peak boolean, bra_logfc double"
    first = [(1, 1, "UNSUPPORTED", "SPANNING_DELETION", None, None, None, None, None, None, None, None), (0, 2, "PENDING", None, None, None, None, None, None, 9.0, None, None)]
    second = [(0, 1, "PENDING", None, "r1", True, "Brain", "cds", '[{"gene_name":"N"}]', -0.5, True, 0.25)]
    spark.createDataFrame(first, schema).write.parquet(str(tmp_path / "b/bucket=10"))
    spark.createDataFrame(second, schema).write.parquet(str(tmp_path / "b/bucket=2"))
    models = lines(tmp_path / "m.json", json.dumps({"models": [{"model_id": "1", "name": "Liver", "column_prefix": "liv"}, {"model_id": "2", "name": "Brain", "column_prefix": "bra"}]}))
    sinks.write_manifest(spark, str(tmp_path / "i.json"), good := {"input_digest": digest, "record_count": 2, "alt_occurrence_count": 3})
    cli.main(["export", vcf, str(tmp_path / "b"), models, str(tmp_path / "i.json"), str(tmp_path / "o")], spark)
    rows = [r.value for r in readers._text(spark, str(tmp_path / "o")).orderBy("line").collect() if not r.value.startswith("#")]
    assert rows[0].split("\t")[7] == "DB;GF1_STATUS=SCORED,NO_RESULT;GF1_PRIORITIZED=1,.;GF1_MAX_ABS_LOGFC=0.5,.;GF1_TOP_MODEL=M0002,.;GF1_REGION=cds,.;GF1_NEAREST_GENE=N,.;GF1_MODEL_SCORE=1|M0001|-0.5|.|.|1|.,1|M0002|0.25|.|.|.|."
    assert rows[1].split("\t")[7] == "GF1_STATUS=UNSUPPORTED;GF1_ERROR=SPANNING_DELETION"
    for wrong in ({"input_digest": "0"}, {"record_count": 3}):
        with pytest.raises(augment.Misaligned):
            pipelines.export_vcf(spark, vcf, str(tmp_path / "b"), [], good | wrong, str(tmp_path / "x"), "GF1")


def test_lookup(spark, tmp_path):
    table = spark.createDataFrame([("chr1", 5, "A", "T", "hg38", "P", t, "V1A", 0.5, "ambiguous") for t in ("T1", "T2")] + [("chr2", 5, "A", "T", "hg38", "P", "T3", "V1A", 0.5, "benign")], "CHROM string, POS int, REF string, ALT string, genome string, uniprot_id string, transcript_id string, protein_variant string, am_pathogenicity double, am_class string")
    sinks.write_hive(table, str(tmp_path / "t"))
    v = readers.read_tsv(spark, lines(tmp_path / "v.tsv", "1\t5\tA\tT\tx", "chr1\t6\tA\tT\t"))
    rows, stats = pipelines.lookup_scores(spark, v, str(tmp_path / "t"))
    assert stats == {"matched_rows": 2, "matched_variants": 1, "output_rows": 3}
    assert sorted((r.chr, r.pos, r.transcript_id or "") for r in rows.collect()) == [("1", 5, "T1"), ("1", 5, "T2"), ("chr1", 6, "")]
