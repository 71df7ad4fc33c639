"""Steps that read or make their input as often as needed, and no more."""

import re

from pyspark.sql import functions as F



def test_order_is_checked_by_hashed_sums_and_across_gaps(spark, monkeypatch):
    from genoframe.operators import ingest, ordinal

    monkeypatch.setattr(ordinal, "RUN", 4)
    # (ordinal, rid, pos, mark); 3 and 4 are missing, as blank lines leave gaps
    rows = [("a", k, 1, k, False) for k in (0, 1, 2)] + [("a", 5, 1, 1, False), ("a", 6, 1, 0, True), ("b", 0, 2, 9, False), ("b", 9, 2, 9, True), ("c", 0, None, 5, False), ("c", 1, 1, 4, False), ("c", 2, None, 3, False)]
    df = spark.createDataFrame(rows, "f string, o long, rid int, pos long, mark boolean")
    found = ordinal.first_wrong_by(df, ["f"], "o", ["rid", "pos"], "mark")
    assert {r.f: (r.descent, r.marked) for r in found.collect()} == {"a": (5, 6), "b": (None, 9), "c": (2, None)}
    assert "SortAggregate" not in ordinal.first_wrong_by(df, ["f"], "o", ["rid", "pos"], "mark")._jdf.queryExecution().executedPlan().toString()
    alts = ["A", "A,<NON_REF>", "<*>", "A<*>", "<*>X,A", ".", None, "A,<*>,C"]
    got = spark.createDataFrame([(x, 5, 5) for x in alts], "alt_raw string, pos long, stop long").select(ingest.is_genomic().alias("g")).collect()
    assert [r.g for r in got] == [False, True, True, False, False, False, False, True]


def test_parts_of_an_augmented_vcf_follow_the_ordinals(spark, tmp_path, monkeypatch):
    from genoframe.operators import augment
    from genoframe.sources import readers, sinks

    monkeypatch.setattr(sinks, "PART", 10)
    (tmp_path / "in.vcf").write_text("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n" + "".join(f"chr1\t{k + 1}\t.\tA\tC\t.\t.\tAC={k}{';GF_STATUS=old' if k % 3 else ''}\n" for k in range(95)))
    header, records = readers.read_vcf_records(spark, str(tmp_path / "in.vcf"))
    notes = records.where("pos % 2 = 0").select("record_ordinal", F.lit("S").alias("STATUS"))
    sinks.write_augmented_vcf(header, records, notes, str(tmp_path / "out"), "GF")
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "out").glob("part-*"))]
    assert len(parts) == 4 and max(map(len, parts)) <= 27
    assert [x for p in parts for x in p] == header + [f"chr1\t{k + 1}\t.\tA\tC\t.\t.\tAC={k}{';GF_STATUS=S' if k % 2 else ''}" for k in range(95)]
    texts = ["GF_STATUS=x", "A=1;;B", "", ".", "XGF_A=1;GF_A;C", None]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select(augment.without_own_info(F.col("x"), "GF").alias("y")).collect()
    assert [r.y for r in got] == [".", "A=1;;B", "", ".", "XGF_A=1;C", None]


def test_blocks_of_fasta_lines_are_summed_up_without_their_letters(spark, tmp_path, monkeypatch):
    from genoframe.operators import contigs
    from genoframe.sources import readers

    monkeypatch.setattr(readers, "LINE_BLOCK", 3)
    (tmp_path / "x.fa").write_text("TT\n>a one\nACGT\n\nAC\nGG  \n>b\n>c\nA\nC\nG\nT\nA\nC\n")
    chunks = readers.read_fasta_chunks(spark, str(tmp_path / "x.fa"))
    assert {r.contig: r.seq for r in contigs.whole(chunks).collect()} == {"a": "ACGTACGG", "c": "ACGTAC"}
    lines = readers.read_fasta_chunks(spark, str(tmp_path / "x.fa"))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [next(x for x in lines[k + 1 :] if "Project [" in x) for k, x in enumerate(lines) if "Window [" in x and "_block" in x and "sum(_len" in x and "last(" not in x]
    carried = [bool(re.search(r"AS value#\d+[,\]]|[\[ ]value#\d+[,\]]", x)) for x in below]
    assert carried.count(True) == 1 and len(carried) >= 2


def test_texts_of_first_chunks_are_made_once(spark, tmp_path):
    from genoframe.operators import contigs

    size = contigs.SIZE
    texts = [("a", "ACGT" * 10), ("b", "ACGTT" * 40_000), ("c", None), ("d", ""), ("e", "GA" * size)]
    spark.createDataFrame(texts, "contig string, seq string").write.parquet(str(tmp_path / "texts"))
    whole = spark.read.parquet(str(tmp_path / "texts"))
    places = [(k, c, at) for k, (c, at) in enumerate((c, at) for c in ("a", "b", "c", "d", "e", "x", None) for at in (None, 0, 30, size - 5, size + contigs.OVERLAP - 3, size + 9000, 3 * size, 9 * size))]
    rows = spark.createDataFrame(places, "id int, contig string, at long")
    met = lambda some, texts: contigs.with_text(some, texts, "contig", F.col("at") - 20, F.col("at") + 20)
    got, wanted = met(rows, whole), met(rows, contigs.chunked(whole))
    seen = lambda df: {r.id: r.s for r in df.select("id", F.substring("_seq", (F.col("at") - F.col("_offset") + 1).cast("int"), F.lit(20)).alias("s")).collect()}
    assert got.columns == wanted.columns and seen(got) == seen(wanted)
    known = lambda df: {r.id for r in df.where("_seq IS NOT NULL").collect()}
    assert known(got) == known(wanted) == {k for k, c, _ in places if c in ("a", "b", "d", "e")}
    near = met(rows.where("at < 100"), whole)._jdf.queryExecution().optimizedPlan().toString()
    assert near.count("Relation [") == 1


def test_exons_are_read_once_for_all_that_is_derived(spark, tmp_path):
    from genoframe.operators import regions

    rows = [(t, "c", a, b, s) for t, s in (("t", "+"), ("u", "-"), (None, "+"), ("v", None)) for a, b in ((10, 20), (21, 30), (33, 40), (60, 90), (70, 75), (None, 99), (500, 400))]
    spark.createDataFrame(rows, "tx string, chrom string, start int, end int, strand string").write.parquet(str(tmp_path / "exons"))
    exons = spark.read.parquet(str(tmp_path / "exons"))
    genes = spark.createDataFrame([("c", 5, 9, "-")], "chrom string, start int, end int, strand string")
    table, gaps = regions.region_table(exons, genes), regions.introns(exons)
    pick = lambda df, feature: df.select(feature.alias("feature"), "chrom", "start", "end").where("end >= start")
    apart = pick(exons, F.lit("exon")).unionByName(pick(gaps, F.lit("intron"))).unionByName(pick(regions.splice_sites(gaps), F.col("kind"))).unionByName(pick(regions.splice_regions(gaps), F.lit("splice_region"))).unionByName(pick(regions.promoters(genes), F.lit("promoter")))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, apart.collect()))
    assert regions.region_table(exons, genes)._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_results_of_stored_alleles_are_stored_without_another_numbering(spark, sf_dir, monkeypatch):
    from genoframe.plans import file_queries
    from genoframe.sources import bucketed

    write, plans = bucketed.write, []

    def kept(df, path, keys, *more, **told):
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        plans.append(df.repartition(buckets, *keys)._jdf.queryExecution().executedPlan().toString())  # as it is stored
        return write(df, path, keys, *more, **told)

    monkeypatch.setattr(bucketed, "write", kept)
    merged = file_queries.FILE_QUERIES["bucketed_merge"](spark, sf_dir)
    alleles, results = plans
    # alleles are dealt to slices and then to buckets; results lie in their buckets and are not numbered
    assert alleles.count("Exchange") > 1 and "monotonically_increasing_id" in alleles
    assert "Exchange" not in results and "monotonically_increasing_id" not in results
    assert merged.columns == ["record_ordinal", "alt_index", "alt", "error_code", "result_variant_id", "score", "gene"]
    assert "hashpartitioning" not in merged._jdf.queryExecution().executedPlan().toString()
