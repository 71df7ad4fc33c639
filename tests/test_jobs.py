"""The runnable jobs: repeated and stopped runs, growing input, the command line."""

import json
import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import cohort_ingest, common, model_inputs, registered


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_registered_job_against_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in ("documents", "lineitem"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, wanted = registered.QUERIES[name](spark, sf_dir), c.sql(registered.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    assert rows_of(got, *columns) == sorted(wanted.project(", ".join(f'"{x}"' for x in columns)).fetchall(), key=repr)


# ---- model inputs


def inputs(spark, tmp_path):
    """Two contigs, one of three chunks; variants at their ends, unknown, repeated and broken ones."""
    long = "ACGT" * 40_000
    spark.createDataFrame([("a", long), ("b", "ACGTACGTAC"), ("none", None)], "contig string, seq string").write.parquet(f"{tmp_path}/tables/contigs.parquet")
    rows = [
        (1, "a", "1", 101, "A", "T"), (1, "a", "1", 101, "A", "T"), (2, "a", "chrX", 150_001, "A", "G"), (3, "a", "chr1", 65_530, "C", "CC"), (4, "a", "chr1", 101, "C", "T"), (5, "b", "chr1", 5, "A", "C"), (6, "c", "chr1", 101, "A", "C"),
        (7, "a", "chr1", 159_999, "GT", "T"), (8, "a", "chr1", 101, "A", ""), (9, "a", "chr1", 101, "A", "n"), (10, None, None, 101, "A", "C"), (11, "a", "chr2", None, "A", "C"), (12, "none", "chr2", 5, "A", "C"), (13, "a", "chr30", 101, "A", "C"), (14, "a", "chr1", 10**9, "A", "C"),
    ]
    spark.createDataFrame(rows, "id long, contig string, chrom string, pos long, ref string, alt string").write.parquet(f"{tmp_path}/tables/variants.parquet")
    own = lambda *names: {n: n for n in names}
    return {"width": 8, "contigs": {"table": "contigs.parquet", "columns": own("contig", "seq")}, "variants": {"table": "variants.parquet", "columns": own("id", "contig", "chrom", "pos", "ref", "alt")}}


def test_model_inputs_are_written_by_outcome(spark, tmp_path):
    config = inputs(spark, tmp_path)
    told = model_inputs.run(spark, f"{tmp_path}/tables", f"{tmp_path}/out", config)
    got = {(r.id, r.error_code): (r.status, r.ref_seq, r.alt_seq, r.chrom) for r in model_inputs.read(spark, f"{tmp_path}/out").collect()}
    assert got[(1, None)] == ("PENDING", "ACGTACGT", "ACGTTCGT", "chr1") and got[(2, None)] == ("PENDING", "ACGTACGT", "ACGTGCGT", "chrX")
    assert got[(3, None)] == ("PENDING", "CGTACGTA", "CGTACCGT", "chr1") and got[(5, None)] == ("PENDING", "ACGTACGT", "ACGTCCGT", "chr1")
    codes = {i: code for i, code in got}
    assert [codes[i] for i in (4, 6, 8, 9, 10, 11, 12, 13, 14)] == ["REF_MISMATCH", "INVALID_CHROMOSOME", "EMPTY_ALLELE", "INVALID_ALTERNATE", "INVALID_CHROMOSOME", "GENOME_ACCESS_ERROR", "INVALID_CHROMOSOME", "INVALID_CHROMOSOME", "REF_MISMATCH"]
    assert codes[7] == "ALT_LENGTH_MISMATCH"
    assert told["variants"] == 15 == sum(n for name, n in told.items() if name not in ("contigs", "variants")) and told["contigs"] == 3
    assert "status=PENDING" in os.listdir(f"{tmp_path}/out/variants") and "chrom=chrX" in os.listdir(f"{tmp_path}/out/variants/status=PENDING")


def test_model_inputs_run_again_is_the_same(spark, tmp_path):
    config = inputs(spark, tmp_path)
    columns = ["id", "contig", "chrom", "pos", "ref", "alt", "error_code", "ref_seq", "alt_seq", "status"]
    first = model_inputs.run(spark, f"{tmp_path}/tables", f"{tmp_path}/out", config)
    one = rows_of(model_inputs.read(spark, f"{tmp_path}/out"), *columns)
    assert model_inputs.run(spark, f"{tmp_path}/tables", f"{tmp_path}/out", config) == first
    assert rows_of(model_inputs.read(spark, f"{tmp_path}/out"), *columns) == one and len(one) == 15
    # fewer variants: nothing of the earlier run is left
    config["variants"]["where"] = "chrom = 'chrX'"
    model_inputs.run(spark, f"{tmp_path}/tables", f"{tmp_path}/out", config)
    assert [r[0] for r in rows_of(model_inputs.read(spark, f"{tmp_path}/out"), "id")] == [2]


# ---- cohort ingest

CONFIG = {"files_per_batch": 1, "records": {"table": "calls", "columns": {"chrom": "chrom", "pos": "pos", "ref": "ref", "alt_raw": "alts", "variant_id": "id"}}}
CALLS = "chrom string, pos long, ref string, alts string, id string, extra string"
FIRST = [("1", 5, "A", "C,T", "rs1", "x"), ("chr1", 5, "A", "C", None, "x"), ("chrX", 7, "AT", "*", "rs2", "x"), (None, 1, "A", "C", None, None)]
SECOND = [("1", 5, "A", "T,G", None, "y"), ("chr2", 9, "G", "<DEL>", "rs3", "y"), ("chr2", 9, "G", None, "rs4", "y"), ("chr1", 5, "A", "C,T", "rs1", "x")]


def add(spark, tmp_path, rows):
    spark.createDataFrame(rows, CALLS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/tables/calls")


def ingest(spark, tmp_path, checkpoint="checkpoint"):
    return cohort_ingest.run(spark, f"{tmp_path}/tables", f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", CONFIG)


def state(spark, tmp_path):
    read = lambda name: cohort_ingest.read(spark, f"{tmp_path}/out", name)
    return rows_of(read("occurrences"), "chrom", "pos", "ref", "alt", "alt_index", "variant_id", "error_code", "canonical_id"), rows_of(read("canonical"), "chrom", "canonical_id", "batch"), rows_of(read("counts").groupBy("chrom", "error_code").agg(F.sum("rows").alias("n")), "chrom", "error_code", "n")


def test_a_second_run_takes_only_what_is_new(spark, tmp_path):
    add(spark, tmp_path, FIRST)
    assert ingest(spark, tmp_path) == {"batches": 1, "occurrences": 5, "supported": 4, "alleles": 3}
    before = {f: os.path.getmtime(f"{tmp_path}/out/occurrences/batch=0/{f}") for f in os.listdir(f"{tmp_path}/out/occurrences/batch=0")}
    assert ingest(spark, tmp_path)["batches"] == 0
    add(spark, tmp_path, SECOND)
    assert ingest(spark, tmp_path) == {"batches": 1, "occurrences": 10, "supported": 8, "alleles": 4}
    assert before == {f: os.path.getmtime(f"{tmp_path}/out/occurrences/batch=0/{f}") for f in os.listdir(f"{tmp_path}/out/occurrences/batch=0")}
    occurrences, canonical, counts = state(spark, tmp_path)
    assert canonical == sorted([("chr1", "chr1:5:A:C", 0), ("chr1", "chr1:5:A:T", 0), ("chr1", "chr1:5:A:G", 1), (None, "1:A:C", 0)], key=repr)
    assert len(occurrences) == 10 and sum(n for *_, n in counts) == 10
    assert ("chrX", "SPANNING_DELETION", 1) in counts and ("chr2", "SYMBOLIC_ALT", 1) in counts
    assert ingest(spark, tmp_path)["batches"] == 0 and state(spark, tmp_path) == (occurrences, canonical, counts)


def test_a_batch_that_failed_is_taken_once(spark, tmp_path, monkeypatch):
    add(spark, tmp_path, FIRST)
    ingest(spark, tmp_path)
    add(spark, tmp_path, SECOND)
    whole = cohort_ingest._write

    def broken(rows, out, name, batch):
        whole(rows, out, name, batch)
        if name == "canonical":
            raise OSError("stopped after the second table")

    monkeypatch.setattr(cohort_ingest, "_write", broken)
    with pytest.raises(Exception, match="stopped after"):
        ingest(spark, tmp_path)
    monkeypatch.setattr(cohort_ingest, "_write", whole)
    ingest(spark, tmp_path)
    occurrences, canonical, counts = state(spark, tmp_path)
    assert len(occurrences) == 10 and len(canonical) == 4 and sum(n for *_, n in counts) == 10


def test_a_new_checkpoint_starts_over(spark, tmp_path):
    add(spark, tmp_path, FIRST)
    add(spark, tmp_path, SECOND)
    assert ingest(spark, tmp_path)["batches"] == 2
    wanted = state(spark, tmp_path)
    ingest(spark, tmp_path, "another")
    got = state(spark, tmp_path)
    assert got[0] == wanted[0] and got[2] == wanted[2] and [x[:2] for x in got[1]] == [x[:2] for x in wanted[1]]


def test_command_line(spark, sf_dir, tmp_path):
    (tmp_path / "own.json").write_text(json.dumps(common.settings("cohort_ingest") | {"files_per_batch": 5}))
    args = [sys.executable, "-m", "jobs.cohort_ingest", "--tables", sf_dir, "--out", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/checkpoint", "--config", f"{tmp_path}/own.json"]
    ran = subprocess.run(args, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    told = json.loads(ran.stdout.strip().splitlines()[-1])
    assert told["batches"] == 1 and told["occurrences"] == cohort_ingest.read(spark, f"{tmp_path}/out", "occurrences").count() > 0
    assert "wrote" in ran.stderr and "read" in ran.stderr
