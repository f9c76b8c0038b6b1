"""Ordered scans and cut-offs against plain Python, with one group that holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.ordered import (
    SLICE, following, keep_until, latest, number, order_rows, previous, running_any, running_max, running_min, running_sum,
)


def rows(seed, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(30)}"
        out.append((key, rng.randrange(8), i, None if rng.random() < 0.2 else rng.randrange(-50, 50)))
    rng.shuffle(out)
    return out


def model(data):
    groups, out = {}, {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    for group in groups.values():
        for i, r in enumerate(group):
            past = [x[3] for x in group[:i]]
            upto = past + [r[3]]
            known = lambda xs: [x for x in xs if x is not None]
            out[r[2]] = (
                i, sum(known(upto)), sum(known(past)), min(known(upto), default=None), min(known(past), default=None),
                max(known(upto), default=None), past[-1] if past else None,
                group[i + 1][3] if i + 1 < len(group) else None, (known(past) or [None])[-1],
                any(x > 40 for x in known(past)),
            )
    return out


def scans():
    return dict(
        n=number(0), total=running_sum("v"), before=running_sum("v", False), low=running_min("v"),
        low_before=running_min("v", False), high=running_max("v"), prev=previous("v"), next=following("v"),
        seen=latest("v", False), big=running_any(F.col("v") > 40, False),
    )


@pytest.mark.parametrize("seed,per_slice", [(1, 1000), (2, 50), (3, 7), (4, 1)])
def test_scans(spark, seed, per_slice):
    data = rows(seed)
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    ordered = order_rows(df, ["k"], ["t", "id"], per_slice)
    names = list(scans())
    got = {r.id: tuple(r[n] for n in names) for r in ordered.scan(**scans()).rows().collect()}
    assert got == model(data)
    if per_slice < 100:
        sizes = [r["count"] for r in ordered.df.groupBy("k", SLICE).count().collect()]
        assert max(sizes) < 0.5 * len(data)


def test_chained_scans_are_staged(spark):
    data = rows(5)
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    once = order_rows(df, ["k"], ["t", "id"], 20).scan(n=number(0))
    twice = once.scan(last_n=previous("n")).rows().collect()
    assert all(r.last_n == (r.n - 1 if r.n else None) for r in twice)


def test_null_keys_and_order(spark):
    data = [(None if i % 3 == 0 else "a", None if i == 5 else i, i, i) for i in range(60)]
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    whole = order_rows(df, ["k"], ["t", "id"]).scan(s=running_sum("v")).rows()
    cut = order_rows(df, ["k"], ["t", "id"], 5).scan(s=running_sum("v")).rows()
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


@pytest.mark.parametrize("per_slice", [1000, 23])
@pytest.mark.parametrize("limit", [0, 1, 77, 5000, 10**9])
def test_keep_until(spark, per_slice, limit):
    data = [(i % 5, i, (i * 37) % 60) for i in range(300)]
    df = spark.createDataFrame(data, "shard int, id int, w int")
    kept, total = [], 0
    for r in sorted(data):
        if total >= limit:
            break
        kept.append(r)
        total += r[2]
    got = keep_until(df, ["shard", "id"], "w", limit, per_slice).collect()
    assert sorted(tuple(r) for r in got) == kept


@pytest.mark.parametrize("early", [True, False])
def test_keep_until_counts_null_keys_first(spark, early):
    df = spark.createDataFrame([(None if i % 4 == 0 else i, i) for i in range(80)], "a int, id int")
    got = sorted(r.id for r in keep_until(df, ["a", "id"], F.lit(1), 30, 7, early).collect())
    want = sorted((r for r in range(80)), key=lambda i: (i % 4 != 0, i))[:30]
    assert got == sorted(want)


def test_keep_until_reads_only_the_beginning(spark, tmp_path):
    spark.range(1000).select(F.col("id").alias("shard"), F.col("id")).write.parquet(str(tmp_path / "t"))
    kept = keep_until(spark.read.parquet(str(tmp_path / "t")), ["shard", "id"], F.lit(1), 5, 50)
    assert kept.count() == 5 and "LessThanOrEqual(shard,4)" in kept._jdf.queryExecution().toString()


def test_cut_plan_does_not_sort_a_group_whole(spark):
    df = spark.createDataFrame(rows(6), "k string, t int, id int, v int")
    plan = order_rows(df, ["k"], ["t", "id"], 40).scan(n=number()).rows()._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan
