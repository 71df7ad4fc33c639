import zlib
import struct
import random
"""Real files in, real files out."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from genoframe.operators import augment, contigs, family, ingest, regions
from genoframe.sources import bucketed, readers, sinks
from genoframe.streaming.batches import ingest_folder, ingest_vcf_folder

HEADER = ["##fileformat=VCFv4.2", "##contig=<ID=chr2>", "##contig=<ID=chr1>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
BODY = ["chr2\t101\trs1\tA\tT,G\t.\tPASS\tAC=1", "chr2\t101\t.\tA\tT\t.\tPASS\t.", "", "chr1\t5\tx\tC\t<DEL>,*\t.\tPASS\tEND=9", "chr1\t7\ty\tC\t.\t.\tPASS\t."]


def write(path, lines, pack=None):
    text = "\n".join(lines) + "\n"
    path.write_bytes(gzip.compress(text.encode()) if pack else text.encode())
    return str(path)


def test_formats():
    assert [readers.resolve_format(p) for p in ("a.VCF.gz", "b.tsv", "c.vcf.bgz", "d.txt")] == ["vcf", "tsv", "vcf", "tsv"]
    for path, fmt, code in (("a.bcf", "auto", "UNSUPPORTED_BCF"), ("a.csv", "auto", "UNKNOWN_FORMAT"), ("a.vcf", "maf", "UNKNOWN_FORMAT")):
        with pytest.raises(readers.InputError) as e:
            readers.resolve_format(path, fmt)
        assert e.value.code == code


def test_table(spark, tmp_path):
    path = write(tmp_path / "v.tsv", ["chr1\t5\tA\tT\tid1", "2\t6\tC\t*", "chr1\t7\tC\tG\t"])
    assert [tuple(r) for r in readers.read_variants(spark, path).orderBy("pos").collect()] == [("chr1", 5, "A", "T", "id1"), ("2", 6, "C", "*", None), ("chr1", 7, "C", "G", None)]
    got = [(r.record_ordinal, r.chr, r.alt_index, r.variant_id, r.status) for r in readers.tsv_occurrences(spark, path, "g").orderBy("record_ordinal").collect()]
    assert got == [(0, "chr1", 1, "id1", "PENDING"), (1, "chr2", 1, None, "UNSUPPORTED"), (2, "chr1", 1, None, "PENDING")]
    for bad in ("chr1\t5\tA", "chr1\tx\tA\tT"):
        with pytest.raises(readers.InputError, match="MALFORMED_TSV"):
            readers.tsv_occurrences(spark, write(tmp_path / "bad.tsv", [bad]), "g")


@pytest.mark.parametrize(("name", "pack"), [("a.vcf", None), ("a.vcf.gz", 1), ("a.vcf.bgz", 1)])
def test_vcf(spark, tmp_path, name, pack):
    path = write(tmp_path / name, HEADER + BODY, pack)
    assert sorted((r.chr, r.pos, r.alt, r.variant_id or "") for r in readers.read_variants(spark, path).collect()) == [("chr2", 101, "G", "rs1"), ("chr2", 101, "T", ""), ("chr2", 101, "T", "rs1")]


def test_vcf_occurrences(spark, tmp_path):
    path = write(tmp_path / "a.vcf", HEADER + [x for x in BODY if x])
    got = [(r.record_ordinal, r.alt_index, r.alt, r.error_code, r.canonical_variant_id) for r in readers.vcf_occurrences(spark, path, "g").orderBy("record_ordinal", "alt_index").collect()]
    assert got == [(0, 1, "T", None, "chr2:101:A:T"), (0, 2, "G", None, "chr2:101:A:G"), (1, 1, "T", None, "chr2:101:A:T"), (2, 1, "<DEL>", "SYMBOLIC_ALT", "chr1:5:C:<DEL>"), (2, 2, "*", "SPANNING_DELETION", "chr1:5:C:*")]
    for lines, code in (
        ([*HEADER[:3], "##GVCFBlock0-1=x", HEADER[3]], "UNSUPPORTED_GVCF"), ([*HEADER[:3], '##ALT=<ID=NON_REF,Description="x">', HEADER[3]], "UNSUPPORTED_GVCF"), ([*HEADER, "chr2\t1\t.\tA\tT,<NON_REF>\t.\t.\t."], "UNSUPPORTED_GVCF"),
        ([*HEADER, "chr2\t1\t.\tA\t.\t.\t.\tEND=50"], "UNSUPPORTED_GVCF"), ([*HEADER, "chr2\t9\t.\tA\tT\t.\t.\t.", "chr2\t8\t.\tA\tT\t.\t.\t."], "UNSORTED_VCF"), ([HEADER[0], HEADER[3], "chr2\t9\t.\tA\tT\t.\t.\t.", "chr1\t8\t.\tA\tT\t.\t.\t.", "chr2\t10\t.\tA\tT\t.\t.\t."], "UNSORTED_VCF"), ([HEADER[0], HEADER[3], "chr2\t9\t.\tA\tT\t.\t.\t.", "chr2\t8\t.\tA\tT\t.\t.\t."], "UNSORTED_VCF"), (HEADER[:3], "MALFORMED_VCF"), ([*HEADER, "chr1\t9\t.\tA\tT\t.\t.\t.", "chr2\t9\t.\tA\tT\t.\t.\t."], "UNSORTED_VCF"), ([*HEADER, "chr2\t9\t."], "MALFORMED_VCF"),
    ):
        with pytest.raises(readers.InputError) as e:
            readers.vcf_occurrences(spark, write(tmp_path / "bad.vcf", lines), "g").count()
        assert e.value.code == code


def blocked(text: bytes, size: int) -> bytes:
    """Block-gzip: members of ``size`` bytes with their length in an extra field, and the empty one that ends the file."""
    out = b""
    for at in [*range(0, len(text), size), None]:
        own = b"" if at is None else text[at : at + size]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(own) + c.flush()
        out += b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\6\0BC\2\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(own), len(own))
    return out


@pytest.mark.parametrize("size", [37, 400, 60_000])
@pytest.mark.parametrize("split", [300, 5_000, 10**8])
@pytest.mark.parametrize("end", ["\n", "", "\r\n"])
def test_block_gzip_is_read_in_splits(spark, tmp_path, size, split, end):
    rng = random.Random(size)
    rows = [f"{k} é中 " + "x" * rng.choice([0, 3, 90]) for k in range(400)] + ["y" * 3000, "", "z"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/b.bgz").write_bytes(blocked(((end or "\n").join(rows) + end).encode(), size))
    (tmp_path / "in/a.bgz").write_bytes(blocked(b"first\nsecond\n", size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        lines = readers._text(spark, str(tmp_path / "in/*.bgz"))
        got = [tuple(r) for r in lines.orderBy("line").select("line", "value").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(enumerate(["first", "second", *rows]))


def test_what_looks_like_a_block_within_one(spark, tmp_path):
    stored = b"before\n" + readers.BLOCK + b"after\n"
    c = zlib.compressobj(0, zlib.DEFLATED, -15)  # stored as it is
    body = c.compress(stored) + c.flush()
    assert readers.BLOCK in body
    whole = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\6\0BC\2\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(stored), len(stored))
    records = whole.split(readers.BLOCK)
    assert b"".join(t for *_, t in readers._inflated(iter([("f", 0, r) for r in records]))) == stored
    with pytest.raises(readers.InputError, match="MALFORMED_BLOCKS"):
        list(readers._inflated(iter([("f", 0, r) for r in records[:-1]])))


def test_positions_must_be_numbers(spark, tmp_path):
    path = write(tmp_path / "a.vcf", [*HEADER, "chr2\t7\t.\tA\tC\t.\t.\t.", "chr2\tseven\t.\tA\tC\t.\t.\t."])
    for read in (readers.read_vcf, lambda s, p: readers.vcf_occurrences(s, p, "g")):
        with pytest.raises(readers.InputError, match=r"MALFORMED_VCF.*a\.vcf:6"):
            read(spark, path)


def test_thousands_of_samples(spark, tmp_path):
    names = [f"S{k}" for k in range(2504)]
    cells = [f"{k % 2}|{k % 3}:{k}" if k % 5 else "./." for k in range(2504)]
    path = write(tmp_path / "a.vcf", [*HEADER[:3], "\t".join([HEADER[3], "FORMAT", *names]), "\t".join(["chr2\t5\t.\tA\tC,G\t.\t.\t.\tGT:DP", *cells])])
    header, records = readers.read_vcf_records(spark, path)
    calls = readers.parse_calls(records, readers.samples_of(header))
    got = calls.first().calls
    assert len(got) == 2504 and all(got[f"S{k}"].gt == ([k % 2, k % 3] if k % 5 else [None, None]) and got[f"S{k}"].dp == (k if k % 5 else None) for k in range(2504))
    size = lambda n: len(readers.parse_calls(records, names[:n])._jdf.queryExecution().optimizedPlan().toString())
    assert size(2504) < size(4) + 40_000  # the names, and nothing else for each
    assert [(r.alt, r.error_code) for r in readers.vcf_occurrences(spark, path, "g", "S2").orderBy("alt_index").collect()] == [("C", "NOT_CARRIED_BY_TARGET"), ("G", None)]


def test_vcf_without_contig_lines_and_genomic_names(spark, tmp_path):
    path = write(tmp_path / "a.vcf", [HEADER[0], HEADER[3], *[x for x in BODY if x]])
    assert readers.vcf_occurrences(spark, path, "g").count() == 5
    for name in ("a.gvcf", "A.gVCF.gz", "a.gvcf.bgz"):
        with pytest.raises(readers.InputError, match="UNSUPPORTED_GVCF"):
            readers.vcf_occurrences(spark, write(tmp_path / name, HEADER + BODY, name.lower().endswith("gz")), "g")


def test_lines_of_several_splits_are_numbered_in_order(spark, tmp_path):
    path = write(tmp_path / "a.txt", [f"line {k}" for k in range(5000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers._text(spark, path)
        assert rows.rdd.getNumPartitions() > 1 and [r.value for r in rows.orderBy("line").collect()] == [f"line {k}" for k in range(5000)]
        assert [r.line for r in rows.select("line").orderBy("line").collect()] == list(range(5000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quality_and_filter_are_kept(spark, tmp_path):
    body = ["chr2\t101\trs1\tA\tT,G\t37.50\tq10;s50\tAC=1\tGT\t0/1", "chr2\t102\t.\tA\tT\t.\tPASS\t.\tGT\t./.", "chr1\t5\t.\tC\tG\t1e-3\t.\tDB\tGT\t1|1"]
    source = write(tmp_path / "s.vcf", [*HEADER[:3], HEADER[3] + "\tFORMAT\ta", *body])
    header, records = readers.read_vcf_records(spark, source)
    notes = readers.vcf_occurrences(spark, source, "g").select("record_ordinal").distinct().withColumn("STATUS", F.lit("SCORED"))
    sinks.write_augmented_vcf(augment.header_lines(header, "GF1"), records, notes, str(tmp_path / "o"), "GF1")
    lines = [r.value.split("\t") for r in readers._text(spark, str(tmp_path / "o")).orderBy("line").collect() if not r.value.startswith("#")]
    strip = lambda f: [*f[:7], ";".join(x for x in f[7].split(";") if not x.startswith("GF1_")) or ".", *f[8:]]
    assert ["\t".join(strip(f)) for f in lines] == body


def test_fasta_chunks(spark, tmp_path, monkeypatch):
    import random

    rng = random.Random(5)
    for name, size in (("SIZE", 50), ("OVERLAP", 20), ("PIECE", 16)):
        monkeypatch.setattr(contigs, name, size)
    monkeypatch.setattr(readers, "LINE_BLOCK", 3)
    seqs = {"c1": 437, "c2": 1, "c3": 50, "c4": 333}
    seqs = {k: "".join(rng.choices("ACGTn", k=n)) for k, n in seqs.items()}
    lines = ["junk"]
    for name, seq in seqs.items():
        width = 333 if name == "c4" else 7
        lines += [f">{name} about it", *[seq[k : k + width] + " " for k in range(0, len(seq), width)], ""]
    path = write(tmp_path / "g.fa", lines)
    assert {r.contig: r.seq for r in readers.read_fasta(spark, path).collect()} == seqs
    chunks = readers.read_fasta_chunks(spark, path)
    assert {(r.contig, r.chunk): r.seq for r in chunks.collect()} == {(c, k): s[50 * k : 50 * k + 70] for c, s in seqs.items() for k in range((len(s) - 1) // 50 + 1)}
    plain = spark.createDataFrame(list(seqs.items()), "contig string, seq string")
    assert sorted(map(tuple, contigs.chunked(plain).collect())) == sorted(map(tuple, chunks.collect()))


def test_variants_across_chunk_borders(spark, monkeypatch):
    import random

    from genoframe.operators import inference, validate

    rng = random.Random(8)
    seq = "".join(rng.choices("ACGT", k=500))
    rows = []
    for k in range(300):
        pos = rng.randrange(-3, 520)
        ref = seq[pos - 1 : pos - 1 + rng.choice([1, 2, 9, 90])] if pos > 0 and rng.random() < 0.8 else "A"
        rows.append((k, rng.choice(["chr1"] * 9 + ["chr9"]), pos if k % 50 else None, ref or "A", rng.choice(["T", "GATTACA", "N", ""])))
    variants = spark.createDataFrame(rows, "id int, chrom string, pos long, ref string, alt string")
    plain = spark.createDataFrame([("chr1", seq)], "contig string, seq string")
    width = 20
    check = lambda: ({r.id: (r.error_code, r.status) for r in validate.validate(variants, plain, width).collect()}, {r.id: (r.window_error, r.ref_seq, r.alt_seq) for r in inference.with_windows(variants, plain, width).collect()})
    whole = check()
    for name, size in (("SIZE", 32), ("OVERLAP", 48)):
        monkeypatch.setattr(contigs, name, size)
    assert check() == whole and len({c for c, _ in whole[0].values()}) >= 5
    peaks = spark.createDataFrame([("chr1", 0, 20), ("chr1", 25, 45), ("chr1", 490, 510), ("chr1", -5, 15), ("chr7", 0, 20), ("chr1", 30, 51)], "chr string, window_start long, window_end long")
    assert {(r.window_start, r.seq) for r in contigs.window_sequences(peaks, plain, 20).collect()} == {(0, seq[:20]), (25, seq[25:45])}


def test_target_sample(spark, tmp_path):
    head = [*HEADER[:3], HEADER[3] + "\tFORMAT\tchild\tparent"]
    path = write(tmp_path / "t.vcf", [*head, "chr2\t5\t.\tA\tC,G\t.\t.\t.\tGT:AD:DP:GQ\t0/2:1,2,3:12:40\t0|1:.:.:5", "chr2\t6\t.\tA\tC\t.\t.\t.\tGT\t./.\t1/1"])
    got = [(r.alt, r.error_code) for r in readers.vcf_occurrences(spark, path, "g", "child").orderBy("record_ordinal", "alt_index").collect()]
    assert got == [("C", "NOT_CARRIED_BY_TARGET"), ("G", None), ("C", "NOT_CARRIED_BY_TARGET")]
    with pytest.raises(readers.InputError, match="TARGET_SAMPLE_NOT_FOUND"):
        readers.vcf_occurrences(spark, path, "g", "aunt")
    header, records = readers.read_vcf_records(spark, path)
    calls = readers.parse_calls(records, readers.samples_of(header)).orderBy("record_ordinal").first().calls
    assert (calls["child"].gt, calls["child"].ad, calls["child"].dp, calls["child"].phased) == ([0, 2], [1, 2, 3], 12, False) and (calls["parent"].phased, calls["parent"].dp, calls["parent"].gq) == (True, None, 5)


def test_peaks_fasta_gff(spark, tmp_path):
    narrow = write(tmp_path / "p.narrowPeak", ["chr1\t100\t300\ta\t0\t.\t1\t2\t3\t50", "chr1\t400\t500\tb\t0\t.\t1\t2\t3\t"])
    assert [(r.summit_pos, r.window_start, r.window_end) for r in readers.read_peaks(spark, narrow, 20).orderBy("start").collect()] == [(150, 140, 160), (None, None, None)]
    bed = write(tmp_path / "p.bed", ["chr1\t100\t301", "chr1\t400\t500"])
    assert [r.summit_pos for r in readers.read_peaks(spark, bed, 20).orderBy("start").collect()] == [200, 450]
    fasta = write(tmp_path / "g.fa", [">chr1 one", "ACGT", "acg", ">chr2", "TT"])
    assert {r.contig: r.seq for r in readers.read_fasta(spark, fasta).collect()} == {"chr1": "ACGTacg", "chr2": "TT"}
    gff = write(tmp_path / "a.gff3", ["##gff-version 3", "1\te\tgene\t5\t9\t.\t+\t.\tID=gene:G1;Name=N;biotype=b", "MT\te\tmRNA\t5\t9\t.\t-\t.\tID=transcript:T;Parent=gene:G1", "KI27\te\tgene\t1\t2\t.\t+\t.\tID=gene:G2"])
    rows = readers.read_gff(spark, gff)
    assert sorted(r.chrom for r in rows.collect()) == ["chr1", "chrM"] and regions.transcripts_of(rows).first().name == "N"


def test_scores(spark, tmp_path):
    good = write(tmp_path / "f.tsv", ["variant_id\tcounts_log2fc\tprofile_l1", "a\t1.5\t", "b\t\t2"])
    assert {tuple(r) for r in readers.read_fold_scores(spark, good).collect()} == {("a", 1.5, None), ("b", None, 2.0)}
    with pytest.raises(readers.InputError):
        readers.read_fold_scores(spark, write(tmp_path / "h.tsv", ["id\tx"]))
    with pytest.raises(ValueError, match="duplicate"):
        readers.read_fold_scores(spark, write(tmp_path / "d.tsv", ["variant_id\tcounts_log2fc\tprofile_l1", "a\t1\t1", "a\t1\t1"]))
    table = write(tmp_path / "m.tsv", ["# a", "# b", "# c", "#CHROM\tPOS\tREF\tALT\tgenome\tuniprot_id\ttranscript_id\tprotein_variant\tam_pathogenicity\tam_class", "chr1\t5\tA\tT\thg38\tP\tT1\tV1A\t0.5\tambiguous"])
    assert readers.read_missense(spark, table).first().am_pathogenicity == 0.5


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 2, "x"), ("chr1", 1, None), ("chr2", 3, "y")], "CHROM string, POS int, v string")
    sinks.write_hive(df, str(tmp_path / "hive"))
    back = spark.read.parquet(str(tmp_path / "hive"))
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    plan = back.where("CHROM = 'chr2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(CHROM" in plan
    sinks.write_jsonl(df, str(tmp_path / "j"))
    assert sorted(json.loads(r.value)["v"] or "" for r in spark.read.text(str(tmp_path / "j")).collect()) == ["", "x", "y"]
    sinks.write_tsv(df, str(tmp_path / "t"), header=True, compression="gzip")
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).count() == 3
    routed = spark.createDataFrame([(1, "coding"), (2, "coding")], "id int, category string")
    assert sinks.write_categories(routed, str(tmp_path / "c"), ("coding", "exonic")) == {"coding": 2, "exonic": 0}
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "c/category=coding")).collect()) == ["1", "2"] and spark.read.text(str(tmp_path / "c/category=exonic")).count() == 0


def test_writing_once(spark, tmp_path):
    df, path = spark.range(10), str(tmp_path / "shards")
    assert sinks.write_once(df, path, "a") and not sinks.write_once(df, path, "a") and sinks.write_once(df.limit(3), path, "b")
    manifest = sinks.read_manifest(spark, f"{path}.manifest.json")
    assert manifest["rows"] == 3 and all(len(s["digest"]) == 64 for s in manifest["shards"])


def test_buckets(spark, tmp_path):
    spark.createDataFrame([(1, 1, "a")], "record_ordinal long, alt_index int, x string").write.parquet(str(tmp_path / "b/bucket=0"))
    spark.createDataFrame([(0, 1, 2.0)], "record_ordinal long, alt_index int, y double").write.parquet(str(tmp_path / "b/bucket=1"))
    rows = readers.read_buckets(spark, str(tmp_path / "b")).collect()
    assert [(r.record_ordinal, r.x, r.y) for r in rows] == [(0, None, 2.0), (1, "a", None)]


def test_stored_results_merge_where_they_lie(spark, tmp_path):
    rows = spark.range(600).selectExpr("id div 2 AS record_ordinal", "CAST(id % 2 AS int) + 1 AS alt_index", "'A' AS alt")
    found = rows.selectExpr("record_ordinal", "alt_index", "concat('r', record_ordinal) AS result_variant_id")
    a = bucketed.write(rows, str(tmp_path / "a"), augment.KEY, 5)
    b = bucketed.write(found, str(tmp_path / "b"), augment.KEY, 5)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = augment.merge(a, ingest.require_unique(b, *augment.KEY))
        for df in (merged, b.groupBy(*augment.KEY).count(), a.join(b, augment.KEY, "left_anti")):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 600 and merged.where("result_variant_id = concat('r', record_ordinal)").count() == 600
        short = bucketed.write(found.where("record_ordinal <> 7 OR alt_index = 1"), str(tmp_path / "c"), augment.KEY, 5)
        with pytest.raises(augment.Misaligned, match="missing_result at record 7, allele 2"):
            augment.merge(a, short)
        twice = bucketed.write(found.unionByName(found.limit(1)), str(tmp_path / "d"), augment.KEY, 5)
        with pytest.raises(ingest.DuplicateKeys):
            ingest.require_unique(twice, *augment.KEY)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    again, told = bucketed.read(spark, str(tmp_path / "a"))
    assert told["buckets"] == 5 and sorted(again.collect()) == sorted(rows.collect())


def test_augmented_vcf(spark, tmp_path):
    source = write(tmp_path / "s.vcf", HEADER + [x for x in BODY if x])
    header, records = readers.read_vcf_records(spark, source)
    occ = readers.vcf_occurrences(spark, source, "g")
    res = occ.where("error_code IS NULL").select("record_ordinal", "alt_index", F.lit("r").alias("result_variant_id"), F.lit("cds").alias("REGION"))
    rows = augment.merge(occ.select("record_ordinal", "alt_index", "status", "error_code"), res, check=False)
    rows = rows.withColumns({"STATUS": augment.status(F.col("status"), F.col("result_variant_id")), "ERROR": F.col("error_code")}).select("record_ordinal", "alt_index", "STATUS", "ERROR", "REGION")
    notes = augment.per_record(rows, ["STATUS", "ERROR", "REGION"])

    def once(lines, recs, name):
        sinks.write_augmented_vcf(augment.header_lines(lines, "GF1"), recs, notes, str(tmp_path / name), "GF1")
        return [r.value for r in readers._text(spark, str(tmp_path / name)).orderBy("line").collect()]

    first = once(header, records, "one")
    assert first[-4].endswith("AC=1;GF1_STATUS=SCORED,SCORED;GF1_REGION=cds,cds") and first[-2].endswith("END=9;GF1_STATUS=UNSUPPORTED,UNSUPPORTED;GF1_ERROR=SYMBOLIC_ALT,SPANNING_DELETION")
    assert once(*readers.read_vcf_records(spark, str(tmp_path / "one")), "two") == first


def test_family_context(tmp_path):
    packet = {"id": "F", "proband": {"subject": {"id": "p"}}, "pedigree": {"persons": [{"individualId": "p", "maternalId": "m", "paternalId": "f", "affectedStatus": "AFFECTED"}, {"individualId": "m", "maternalId": "0"}, {"individualId": "f"}, {"individualId": "s", "maternalId": "m", "paternalId": "f"}, {"individualId": "x"}, {"individualId": "u", "maternalId": "m", "paternalId": "f"}]}, "files": [{"uri": "file:///d/a.vcf", "individualToFileIdentifiers": {k: f"S{k}" for k in "pmfsx"}}]}
    path = tmp_path / "f.json"
    path.write_text(json.dumps(packet))
    got = family.load_context(str(path), "/e/a.vcf")
    assert {m["individual"]: m["relationship"] for m in got["members"]} == {"p": "PROBAND", "m": "MOTHER", "f": "FATHER", "s": "SIBLING", "x": "RELATIVE"}
    family.require_samples(got["members"], ["Sp", "Sm", "Sf", "Ss", "Sx"])
    with pytest.raises(ValueError, match="Sx"):
        family.require_samples(got["members"], ["Sp", "Sm", "Sf", "Ss"])
    for change, text in (({"id": ""}, "id"), ({"files": []}, "no file"), ({"files": [{"uri": "a.vcf", "individualToFileIdentifiers": {}}]}, "no sample")):
        path.write_text(json.dumps(packet | change))
        with pytest.raises(ValueError, match=text):
            family.load_context(str(path), "a.vcf")


def test_streamed_ingest(spark, tmp_path):
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    drop.mkdir()
    contigs = spark.createDataFrame([("chr1", "ACGT" * 50)], "contig string, seq string")
    run = lambda: ingest_folder(spark, str(drop), contigs, out, str(tmp_path / "check"), 20)
    write(drop / "1.tsv", ["1\t101\tA\tT", "chr1\t101\tC\tT\tid"])
    run()
    write(drop / "2.tsv", ["chr1\t102\tC\t*"])
    run()
    run()
    rows = {(r.canonical_id, r.status) for r in spark.read.parquet(out).collect()}
    assert rows == {("chr1:101:A:T", "PENDING"), ("chr1:101:C:T", "REF_MISMATCH"), ("chr1:102:C:*", "UNSUPPORTED")} and spark.read.parquet(out).count() == 3


def test_streamed_vcfs(spark, tmp_path):
    """Each file has a header, an order of contigs and record numbers of its own; files that are refused do not stop the others."""
    drop, out = tmp_path / "drop", str(tmp_path / "out")
    (drop / "below").mkdir(parents=True)
    contigs = spark.createDataFrame([("chr1", "ACGT" * 50), ("chr2", "ACGT" * 50)], "contig string, seq string")
    run = lambda: ingest_vcf_folder(spark, str(drop), contigs, out, str(tmp_path / "check"), 20, files=2)
    columns = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"
    record = lambda chrom, pos, ref, alt, info=".": f"{chrom}\t{pos}\t.\t{ref}\t{alt}\t.\t.\t{info}"
    write(drop / "a.vcf", ["##contig=<ID=chr2>", "##contig=<ID=chr1>", columns, record("chr2", 101, "A", "T,C"), "", record("chr1", 101, "C", "T"), record("chr1", 102, "C", ".")])
    write(drop / "below/b.vcf", [columns, record("chr1", 101, "A", "T"), record("chr1", 102, "C", "*")])
    run()
    rows = lambda: sorted((r.file[-5:], r.record_ordinal, r.alt_index, r.canonical_id, r.status) for r in spark.read.parquet(f"{out}/occurrences").collect())
    first = [("a.vcf", 0, 1, "chr2:101:A:T", "PENDING"), ("a.vcf", 0, 2, "chr2:101:A:C", "PENDING"), ("a.vcf", 2, 1, "chr1:101:C:T", "REF_MISMATCH"), ("b.vcf", 0, 1, "chr1:101:A:T", "PENDING"), ("b.vcf", 1, 1, "chr1:102:C:*", "UNSUPPORTED")]
    assert rows() == first
    with gzip.open(drop / "c.vcf.gz", "wt") as f:
        f.write("\n".join([columns, record("chr2", 103, "G", "A")]) + "\n")
    bad = {"d": [record("chr1", 1, "A", "C")], "e": [columns, "chr1\tx\t.\tA\tC"], "f": [columns, record("chr1", 9, "A", "C"), record("chr1", 8, "A", "C")], "g": [columns, record("chr1", 9, "A", ".", "END=20")], "h": ["##GVCFBlock0-1=minGQ=0", columns], "i.g": [columns], "j": ["##contig=<ID=chr1>", "##contig=<ID=chr2>", columns, record("chr2", 1, "A", "C"), record("chr1", 1, "A", "C")]}
    for name, lines in bad.items():
        write(drop / f"{name}vcf" if name == "i.g" else drop / f"{name}.vcf", lines)
    (drop / "k.vcf").write_text("")
    run()
    run()
    assert rows() == [*first, ("cf.gz", 0, 1, "chr2:103:G:A", "PENDING")]
    told = {r.file.rsplit("/", 1)[1][0]: (r.code, r.message) for r in spark.read.parquet(f"{out}/refused").collect()}
    assert told == {
        "d": ("MALFORMED_VCF", "the header has no line of column names"), "e": ("MALFORMED_VCF", "line 2"), "f": ("UNSORTED_VCF", "record 1"), "g": ("UNSUPPORTED_GVCF", "record 0"),
        "h": ("UNSUPPORTED_GVCF", "##GVCFBlock0-1=minGQ=0"), "i": ("UNSUPPORTED_GVCF", "name"), "j": ("UNSORTED_VCF", "record 1"),
    }


def test_lines_are_numbered_over_files_and_splits(spark, tmp_path):
    sizes = [3, 4000, 1, 900]  # a scan takes large splits first
    wanted = []
    for k, n in enumerate(sizes):
        lines = [f"{k}-{j}-{'x' * (j % 13)}" for j in range(n)]
        (tmp_path / f"part-{k:05d}.txt").write_text("\n".join(lines) + "\n")
        wanted += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers._text(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 5
        got = rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(got, key=lambda r: r.line)] == wanted
    assert sorted(r.line for r in got) == list(range(len(wanted)))
