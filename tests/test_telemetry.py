"""Smoothed loss, budgets, schedules, state rules and log parsing against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import schedules as s
from tidemark.operators import evaluation as ev
from tidemark.operators import jobs as j
from tidemark.operators import telemetry as o


@pytest.mark.parametrize("beta", [0.9, 0.5, 0.99])
def test_smoothed_loss(spark, beta):
    rng = random.Random(1)
    log = [(run, i, rng.uniform(0, 12)) for run, n in ((1, 3000), (2, 1), (3, 257)) for i in range(n)]
    df = spark.createDataFrame(log, "run_id int, step int, loss double")
    got = {(r.run_id, r.step): r.smooth_loss for r in o.smoothed_loss(df, beta=beta).collect()}
    for run in (1, 2, 3):
        ema = 0.0
        for _, i, x in (r for r in log if r[0] == run):
            ema = beta * ema + (1 - beta) * x
            assert math.isclose(got[run, i], ema / (1 - beta ** (i + 1)), rel_tol=1e-9)


def test_until_budget_never_stops_untimed(spark):
    log = spark.createDataFrame([(1, i, 100) for i in range(30)] + [(2, i, 1) for i in range(30)], "run_id int, step int, dt_us bigint")
    kept = {r.run_id: r.m for r in o.until_budget(log, 250).groupBy("run_id").agg(F.max("step").alias("m")).collect()}
    done, want = 0, None
    for step in range(30):
        done += 100 if step > 10 else 0
        if step >= 10 and done >= 250:
            want = step
            break
    assert kept == {1: want, 2: 29}


def test_until_diverged_handles_nan(spark):
    rows = [(1, 0, 2.0), (1, 1, float("nan")), (1, 2, 1.0), (2, 0, 100.0), (2, 1, 100.5), (2, 2, 3.0)]
    log = spark.createDataFrame(rows, "run_id int, step int, loss double")
    assert sorted((r.run_id, r.step) for r in o.until_diverged(log).collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_schedules(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (0.5,), (0.75,), (1.0,)], "p double")
    got = [round(r[0], 6) for r in df.select(s.lr_multiplier(F.col("p"))).collect()]
    assert got == [1.0, 1.0, 1.0, 0.5, 0.0]
    warm = [round(r[0], 6) for r in df.select(s.lr_multiplier(F.col("p"), warmup=0.5, warmdown=0.25, final=0.2)).collect()]
    assert warm == [0.0, 0.5, 1.0, 1.0, 0.2]


def test_step_line_with_overwritten_updates(spark):
    line = (
        "\rstep 00000 (0.0%) | loss: 9.011000 | lrm: 1.00 | dt: 8012ms | tok/sec: 65,432 | mfu: 1.5% | epoch: 1 | remaining: 300s    "
        "\rstep 00001 (12.5%) | loss: 8.500000 | lrm: 0.50 | dt: 395ms | tok/sec: 1,327,310 | mfu: 31.4% | epoch: 1 | remaining: 12s    "
    )
    rows = o.step_lines(spark.createDataFrame([(1, line), (1, "noise")], "run_id int, line string")).orderBy("step").collect()
    assert [(r.step, r.pct, r.loss, r.dt_ms, r.tok_per_sec, r.remaining_s) for r in rows] == [
        (0, 0.0, 9.011, 8012, 65432, 300), (1, 12.5, 8.5, 395, 1327310, 12)]


def test_summary_block(spark):
    block = ["---", "val_bpb:          0.997900", "peak_vram_mb:     45060.2", "depth:            8", "val_bpb is", "other: 3"]
    row = o.run_summaries(spark.createDataFrame([(1, line) for line in block], "run_id int, line string")).head()
    assert (row.val_bpb, row.peak_vram_mb, row.depth, row.num_steps) == (0.9979, 45060.2, 8.0, None)


def test_gpu_snapshot(spark):
    df = spark.createDataFrame([("Card X, 1024, 81920, 97, 55",), ("command not found",)], "l string")
    good, bad = [r.g for r in df.select(o.gpu_snapshot(F.col("l")).alias("g")).collect()]
    assert tuple(good) == ("Card X", 1024.0, 81920.0, 97.0, 55.0) and bad is None


STATES = [
    ("a", 1, 1, "queued"), ("a", 2, 2, ""), ("a", 3, 3, "queued"), ("a", 4, 4, "running"), ("a", 5, 5, "succeeded"), ("a", 6, 6, "running"),
    ("b", 1, 7, ""), ("b", 2, 8, "running"), ("b", 2_000_000_000, 9, "cancelled"),
]


def test_state_rules(spark):
    df = spark.createDataFrame(STATES, "slug string, at_us bigint, event_id bigint, state string")
    ids = lambda rows: sorted(r.event_id for r in rows.collect())
    assert ids(j.state_changes(df)) == [1, 4, 5, 6, 8, 9]
    assert ids(j.state_changes(df, show_unknown=True)) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert ids(j.until_terminal(df)) == [1, 2, 3, 4, 5, 7, 8, 9]
    waited = {r.slug: (r.state, r.timed_out) for r in j.waited_states(df, 1800).collect()}
    assert waited == {"a": ("succeeded", False), "b": ("running", True)}
    assert {r.slug: r.state for r in j.latest_states(df).collect()} == {"a": "running", "b": "cancelled"}


def test_tail_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", i, str(i)) for i in range(50)], "slug string, line_no int, line string")
    tail = j.log_tail(df, 3)
    assert sorted(r.line_no for r in tail.collect()) == [47, 48, 49]
    assert "WindowGroupLimit" in tail._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        j.log_tail(df, 2000)


def test_cross_entropy_and_bits_per_byte(spark):
    rng = random.Random(2)
    logits = [[rng.uniform(-40, 40) for _ in range(5)] for _ in range(20)]
    df = spark.createDataFrame([(x, i % 6 - 1) for i, x in enumerate(logits)], "z array<double>, y int")
    for (x, y), r in zip(((x, i % 6 - 1) for i, x in enumerate(logits)), df.select(ev.cross_entropy(F.col("z"), F.col("y"))).collect()):
        z = [15 * math.tanh(v / 15) for v in x]
        assert r[0] is None if y == -1 else math.isclose(r[0], math.log(sum(map(math.exp, z))) - z[y], rel_tol=1e-12)
    losses = spark.createDataFrame([(1.0, 2), (2.0, 0), (3.0, 4)], "nats double, n int")
    row = ev.bits_per_byte(losses, F.col("nats"), F.col("n")).head()
    assert row.n_bytes == 6 and math.isclose(row.bpb, 4.0 / (math.log(2) * 6))
    assert ev.eval_rows(128) == 80 * 128


def test_price_and_phase_facts(spark):
    runs = spark.createDataFrame([(1, "x", 3600.0), (2, "y", 1800.0)], "run_id int, gpu string, duration_s double")
    prices = spark.createDataFrame([("x", 2.39), ("y", 1.0)], "gpu string, usd_per_hr double")
    assert {r.run_id: r.cost_usd for r in j.priced(runs, prices).collect()} == {1: 2.39, 2: 0.5}
