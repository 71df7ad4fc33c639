"""Ordinals and merges at size: inputs are read and moved as often as needed, and no more."""

import random

from genoframe.operators import augment, ordinal


def _plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()  # not that of a run, which names its first plan too


def _rows(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_slices_are_bisected_and_sorted_in_partitions_of_their_own(spark):
    rng = random.Random(1)
    values = [rng.choice([7, rng.randrange(-(10**12), 10**12), rng.randrange(50)]) for _ in range(3000)] + [None] * 5
    df = spark.createDataFrame([(a, k) for k, a in enumerate(values)], "a long, b long")
    placed = ordinal.with_ordinal(df, ["a", "b"])
    got = {(r.a, r.b): r.record_ordinal for r in placed.collect()}
    wanted = sorted(((a, k) for k, a in enumerate(values)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [got[r] for r in wanted] == list(range(len(values)))
    # a comparison for each halving, not one for each cut; rows are not sorted by their slice first
    optimized = placed._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("get(") <= 8 and "row_number()" not in optimized.lower()
    # what lies above does not change what a row is numbered
    few = {(r.a, r.b): r.record_ordinal for r in placed.where("b % 3 = 0").repartition(2).collect()}
    assert few and all(got[r] == at for r, at in few.items())


def test_slices_of_one_value_and_of_none(spark):
    assert [r.record_ordinal for r in ordinal.with_ordinal(spark.createDataFrame([(5, k) for k in range(40)], "a long, b long"), ["a", "b"]).orderBy("b").collect()] == list(range(40))
    assert ordinal.with_ordinal(spark.createDataFrame([], "a long, b long"), ["a", "b"]).count() == 0


def test_misalignment_reads_each_side_once(spark, tmp_path):
    a = _rows(spark, tmp_path, "a", [(0, 1), (0, 2), (1, 1), (1, 1), (3, 1), (None, 1)], "record_ordinal long, alt_index int")
    b = _rows(spark, tmp_path, "b", [(0, 2), (0, 2), (1, 1), (2, 1), (2, 1)], "record_ordinal long, alt_index int")
    found = augment.misalignment(a, b)
    got = sorted((r.side, r.record_ordinal is None, r.record_ordinal or 0, r.alt_index) for r in found.collect())
    assert got == [("extra_result", False, 2, 1), ("extra_result", False, 2, 1), ("missing_result", False, 0, 1), ("missing_result", False, 3, 1), ("missing_result", True, 0, 1)]
    assert _plan(found).count("FileScan") == 2


def test_whole_records_are_merged_and_grouped_without_another_move(spark, tmp_path):
    a = _rows(spark, tmp_path, "a", [(0, 1), (0, 2), (1, 1), (2, None), (None, 1)], "record_ordinal long, alt_index int")
    b = _rows(spark, tmp_path, "b", [(0, 2, "x"), (0, 2, "y"), (1, 2, "z"), (2, None, "n"), (None, 1, "m")], "record_ordinal long, alt_index int, v string")
    whole = augment.merge(a, b, check=False, by_record=True)
    plain = augment.merge(a, b, check=False)
    assert whole.columns == plain.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _plan(augment.per_record(augment.merge(a, b, check=False, by_record=True), ["v"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


def test_descents_are_found_within_one_reading(spark, tmp_path):
    edge = ordinal.RUN
    rows = [(k, k * 3) for k in range(edge - 3, edge + 3)] + [(2 * edge - 1, 9), (2 * edge, 8), (2 * edge + 2, 1), (3 * edge, 0)]
    rows = [(k, -1) if k == edge else (k, x) for k, x in rows]
    df = _rows(spark, tmp_path, "d", rows, "o long, p long")
    found = ordinal.descents(df, "o", "p")
    assert sorted((r.o, r.p) for r in found.collect()) == [(edge, -1), (2 * edge, 8)]
    assert found.columns == ["o", "p"] and _plan(found).count("FileScan") == 1
