"""Decisions and statistics on a hand-made series with known results."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import experiments as x
from tidemark.sources import readers

VALUES = [1.010748, 1.011738, 1.011043, 0.0, 1.008112, 1.010590, None, 0.998559, 1.048885, 0.998559, 0.985552]
STATUS = ["keep", "discard", "discard", "crash", "keep", "discard", "discard", "keep", "discard", "discard", "keep"]


@pytest.fixture(scope="module")
def series(spark):
    rows = [("t", i, i, v, s.upper(), f"change {i}") for i, (v, s) in enumerate(zip(VALUES, STATUS))]
    return spark.createDataFrame(rows, "tag string, ts int, event_id int, val_bpb double, status string, description string")


@pytest.mark.parametrize("per_slice", ["1000000", "3"])
def test_decisions_reproduce_the_statuses(spark, series, per_slice):
    spark.conf.set("tidemark.rowsPerSlice", per_slice)
    got = [r.decision for r in x.accept_reject(series).orderBy("ts").collect()]
    spark.conf.unset("tidemark.rowsPerSlice")
    assert got == [s.upper() for s in STATUS]


def test_round_winners(series):
    rows = series.withColumns({"round": F.expr("ts div 4"), "candidate": F.col("ts")})
    got = {r.ts: r.decision for r in x.round_winners(rows).collect()}
    assert [got[i] for i in range(11)] == [
        "KEEP", "DISCARD", "DISCARD", "CRASH", "DISCARD", "DISCARD", "DISCARD", "KEEP", "DISCARD", "DISCARD", "KEEP"]


def test_summary(series):
    row = x.improvement(series).head()
    assert (row.baseline, row.best, round(row.gain, 6), round(row.gain_pct, 2)) == (1.010748, 0.985552, 0.025196, 2.49)
    assert x.keep_rate(series).head().keep_rate == 0.4
    assert x.best_rows(series).head().description == "change 10"
    deltas = [round(r.delta, 6) for r in x.ranked_deltas(series).orderBy("rank").collect()]
    assert deltas == [0.013007, 0.009553, 0.002636]
    assert x.near_baseline(series).count() == 7
    assert [(r.idx, r.took) for r in x.effort(series).orderBy("idx").collect()] == [(0, None), (4, 4), (7, 3), (10, 3)]


def test_a_missing_value_keeps_its_row(spark):
    rows = [("t", 0, 0, 3.0, "KEEP"), ("t", 1, 1, None, "KEEP"), ("t", 2, 2, 2.0, "KEEP")]
    df = spark.createDataFrame(rows, "tag string, ts int, event_id int, val_bpb double, status string")
    assert [r.delta for r in x.deltas(df).orderBy("ts").collect()] == [None, None]
    assert [r.best_so_far for r in x.running_best(df).orderBy("ts").collect()] == [3.0, None, 2.0]


def test_no_rows_for_nothing(spark, series):
    none = series.filter("false")
    assert x.keep_rate(none).count() == x.best_rows(none).count() == x.accept_reject(none).count() == 0


def test_number_forms(spark):
    cases = {"1.5": 1.5, " 2 ": 2.0, "1e-3": 0.001, ".5": 0.5, "1.0d": None, "1f": None, "n/a": None, "": None, "nan": None,
             "inf": float("inf"), "-Infinity": float("-inf"), "0x10": None, "1,5": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r.s: r.v for r in df.select("s", t.number_or_null(F.col("s")).alias("v")).collect()} == cases


def test_text_forms(spark):
    df = spark.createDataFrame([("research/My Tag_1/x--", "abc1234")], "b string, c string")
    assert df.select(t.job_name(F.col("b"), F.col("c")).alias("n")).head().n == "research-my-tag-1-x-abc1234"
    names = spark.createDataFrame([("research-a-b-r3-2-0ff1ce0",), ("research-a-0ff1ce0",)], "n string")
    first, second = [r.p for r in names.select(t.parse_job_name(F.col("n")).alias("p")).collect()]
    assert tuple(first) == ("a-b", 3, 2, "0ff1ce0") and second is None
    text = spark.createDataFrame([("  Keep \n", "x" * 46)], "s string, d string")
    row = text.select(t.status(F.col("s")).alias("s"), t.label(F.col("d")).alias("d")).head()
    assert (row.s, row.d) == ("KEEP", "x" * 42 + "...")
    value = spark.createDataFrame([(125, 1.5, -0.25)], "d int, v double, g double")
    row = value.select(t.duration_text(F.col("d")), t.fixed(F.col("v")), t.signed(F.col("g")), t.percent(F.col("v")), t.thousands(F.col("d") * 1000)).head()
    assert tuple(row) == ("2m 05s", "1.500000", "-0.250000", "150.0%", "125,000")


def test_result_file(spark, tmp_path):
    path = tmp_path / "results.tsv"
    path.write_text("commit\tval_bpb\tmemory_gb\tstatus\tdescription\na1\t0.9979\t44.0\tkeep\tbase, \"x\"\nb2\t0.000000\t0.0\tcrash\tNA\nc3\t?\t1\t Discard \t\n")
    rows = x.coerce_results(readers.indexed_result_file(spark, str(path))).orderBy("idx").collect()
    assert [(r.idx, r.val_bpb, r.status, r.description) for r in rows] == [
        (0, 0.9979, "KEEP", 'base, "x"'), (1, 0.0, "CRASH", "NA"), (2, None, "DISCARD", None)]
