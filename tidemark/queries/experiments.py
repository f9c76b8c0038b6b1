"""Queries over experiment results: coercion, outcomes, baselines, running best, decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import experiments as x
from tidemark.plans.ordered import order_rows
from tidemark.queries.registry import query
from tidemark.queries.views import EXPERIMENTS, RAW_RESULTS, with_views
from tidemark.sources import tables


def experiments(spark, folder):
    return x.coerce_results(tables.raw_results(spark, folder))


@query("p3_numeric_coercion", with_views(RAW_RESULTS) + """
SELECT event_id, TRY_CAST(val_text AS DOUBLE) AS val_bpb, TRY_CAST(mem_text AS DOUBLE) AS memory_gb FROM raw_results""")
def p3(spark, folder):
    return tables.raw_results(spark, folder).select(
        "event_id",
        t.number_or_null(F.col("val_text")).alias("val_bpb"),
        t.number_or_null(F.col("mem_text")).alias("memory_gb"),
    )


@query("p4_status_normalise", with_views(RAW_RESULTS) + """
SELECT event_id, upper(trim(status_text, ' ' || chr(9))) AS status FROM raw_results""")
def p4(spark, folder):
    return tables.raw_results(spark, folder).select("event_id", t.status(F.col("status_text")).alias("status"))


@query("p5_status_filters", with_views(EXPERIMENTS) + """
SELECT event_id, status, status = 'KEEP' AS is_kept FROM experiments WHERE status <> 'CRASH'""")
def p5(spark, folder):
    rows = x.valid(experiments(spark, folder))
    return rows.select("event_id", "status", (F.col("status") == x.KEEP).alias("is_kept"))


@query("p6_near_baseline", with_views(EXPERIMENTS).rstrip() + """,
base AS (SELECT tag, val_bpb AS baseline FROM (
  SELECT tag, val_bpb, row_number() OVER (PARTITION BY tag ORDER BY idx) AS rn FROM experiments WHERE status <> 'CRASH')
  WHERE rn = 1)
SELECT event_id, e.tag, val_bpb, status, baseline FROM experiments e JOIN base b ON e.tag = b.tag
WHERE status <> 'CRASH' AND val_bpb <= baseline + 0.0005""")
def p6(spark, folder):
    rows = x.near_baseline(experiments(spark, folder))
    return rows.select("event_id", "tag", "val_bpb", "status", F.col("baseline_valid").alias("baseline"))


@query("p7_labels", with_views(EXPERIMENTS) + """
SELECT event_id, CASE WHEN length(trim(description)) > 45 THEN substr(trim(description), 1, 42) || '...'
  ELSE trim(description) END AS label FROM experiments""")
def p7(spark, folder):
    return tables.raw_results(spark, folder).select("event_id", t.label(F.col("description")).alias("label"))


@query("a3_outcome_counts", with_views(EXPERIMENTS) + """
SELECT status, count(*) AS n FROM experiments GROUP BY status ORDER BY n DESC, status""")
def a3(spark, folder):
    return x.outcome_counts(experiments(spark, folder)).orderBy(F.desc("n"), "status")


@query("a4_keep_rate", with_views(EXPERIMENTS) + """
SELECT tag, n_keep, n_discard, round(n_keep / (n_keep + n_discard), 6) AS keep_rate FROM (
  SELECT tag, count(*) FILTER (status = 'KEEP') AS n_keep, count(*) FILTER (status = 'DISCARD') AS n_discard
  FROM experiments GROUP BY tag) WHERE n_keep + n_discard > 0""")
def a4(spark, folder):
    return x.keep_rate(experiments(spark, folder)).withColumn("keep_rate", F.round("keep_rate", 6))


@query("a5_best_experiment", with_views(EXPERIMENTS) + """
SELECT tag, commit, val_bpb, description FROM (
  SELECT *, row_number() OVER (PARTITION BY tag ORDER BY val_bpb, idx) AS rn FROM experiments
  WHERE status = 'KEEP' AND val_bpb IS NOT NULL) WHERE rn = 1""")
def a5(spark, folder):
    return x.best_rows(experiments(spark, folder)).select("tag", "commit", "val_bpb", "description")


BASELINES = """,
first_any AS (SELECT tag, val_bpb AS baseline_first FROM experiments WHERE idx = 0),
first_valid AS (SELECT tag, val_bpb AS baseline_valid FROM (
  SELECT tag, val_bpb, row_number() OVER (PARTITION BY tag ORDER BY idx) AS rn FROM experiments WHERE status <> 'CRASH')
  WHERE rn = 1),
best AS (SELECT tag, min(val_bpb) AS best FROM experiments WHERE status = 'KEEP' GROUP BY tag)"""


@query("a6_baselines", with_views(EXPERIMENTS).rstrip() + BASELINES + """
SELECT a.tag, baseline_first, baseline_valid FROM first_any a LEFT JOIN first_valid v ON a.tag = v.tag""")
def a6(spark, folder):
    return x.baselines(experiments(spark, folder))


@query("a7_improvement", with_views(EXPERIMENTS).rstrip() + BASELINES + """
SELECT a.tag, baseline_first AS baseline, best, round(baseline_first - best, 6) AS gain,
  round((baseline_first - best) / nullif(baseline_first, 0) * 100, 4) AS gain_pct
FROM first_any a LEFT JOIN best b ON a.tag = b.tag""")
def a7(spark, folder):
    return x.improvement(experiments(spark, folder)).withColumns(
        {"gain": F.round("gain", 6), "gain_pct": F.round("gain_pct", 4)}
    )


@query("a8_total_delta", with_views(EXPERIMENTS) + """
SELECT tag, round(sum(prev - val_bpb), 6) AS total_delta FROM (
  SELECT tag, val_bpb, lag(val_bpb) OVER w AS prev, row_number() OVER w AS rn FROM experiments WHERE status = 'KEEP'
  WINDOW w AS (PARTITION BY tag ORDER BY idx)) WHERE rn > 1 GROUP BY tag""")
def a8(spark, folder):
    rows = x.deltas(experiments(spark, folder))
    return rows.groupBy("tag").agg(F.round(F.sum("delta"), 6).alias("total_delta"))


@query("a9_plot_range", with_views(EXPERIMENTS).rstrip() + BASELINES + """
SELECT a.tag, round(best - 0.15 * (baseline_valid - best), 6) AS low,
  round(baseline_valid + 0.15 * (baseline_valid - best), 6) AS high
FROM first_any a LEFT JOIN best b ON a.tag = b.tag LEFT JOIN first_valid v ON a.tag = v.tag""")
def a9(spark, folder):
    rows = x.plot_range(experiments(spark, folder))
    return rows.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


@query("w1_renumber", with_views(EXPERIMENTS) + """
SELECT event_id, row_number() OVER (PARTITION BY tag ORDER BY idx) - 1 AS valid_idx FROM experiments
WHERE status <> 'CRASH'""")
def w1(spark, folder):
    return x.indexed(x.valid(experiments(spark, folder)), name="valid_idx").select("event_id", "valid_idx")


@query("w2_running_best", with_views(EXPERIMENTS) + """
SELECT event_id, val_bpb, CASE WHEN val_bpb IS NOT NULL THEN min(val_bpb) OVER (PARTITION BY tag ORDER BY idx
  ROWS UNBOUNDED PRECEDING) END AS best_so_far FROM experiments WHERE status = 'KEEP'""")
def w2(spark, folder):
    return x.running_best(experiments(spark, folder)).select("event_id", "val_bpb", "best_so_far")


DELTAS = """,
deltas AS (SELECT * FROM (
  SELECT event_id, tag, idx, val_bpb, lag(val_bpb) OVER w AS prev_bpb, lag(val_bpb) OVER w - val_bpb AS delta,
    row_number() OVER w AS kept_no
  FROM experiments WHERE status = 'KEEP' WINDOW w AS (PARTITION BY tag ORDER BY idx)) WHERE kept_no > 1)"""


@query("w3_deltas", with_views(EXPERIMENTS).rstrip() + DELTAS + """
SELECT event_id, prev_bpb, round(delta, 6) AS delta FROM deltas""")
def w3(spark, folder):
    return x.deltas(experiments(spark, folder)).select("event_id", "prev_bpb", F.round("delta", 6).alias("delta"))


@query("w4_ranked_deltas", with_views(EXPERIMENTS).rstrip() + DELTAS + """
SELECT event_id, tag, row_number() OVER (PARTITION BY tag ORDER BY delta DESC NULLS LAST, idx) AS rank,
  round(delta, 6) AS delta FROM deltas""")
def w4(spark, folder):
    rows = x.ranked_deltas(experiments(spark, folder))
    return rows.select("event_id", "tag", "rank", F.round("delta", 6).alias("delta"))


@query("w10_accept_reject", with_views(EXPERIMENTS) + """
SELECT event_id, tag, idx, val_bpb, CASE WHEN status = 'CRASH' THEN 'CRASH'
  WHEN val_bpb IS NOT NULL AND (best_before IS NULL OR val_bpb < best_before) THEN 'KEEP' ELSE 'DISCARD' END AS decision
FROM (SELECT *, min(CASE WHEN status <> 'CRASH' THEN val_bpb END) OVER (PARTITION BY tag ORDER BY idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM experiments)""")
def w10(spark, folder):
    rows = x.accept_reject(experiments(spark, folder))
    return rows.select("event_id", "tag", "idx", "val_bpb", "decision")


@query("w11_round_winner", with_views(EXPERIMENTS) + """
, rounds AS (SELECT tag, idx // 4 AS round, min(val_bpb) FILTER (status <> 'CRASH') AS top FROM experiments GROUP BY 1, 2),
bases AS (SELECT *, min(top) OVER (PARTITION BY tag ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS base
  FROM rounds),
placed AS (SELECT *, row_number() OVER (PARTITION BY tag, idx // 4
  ORDER BY CASE WHEN status <> 'CRASH' THEN val_bpb END NULLS LAST, idx) AS place FROM experiments)
SELECT p.event_id, p.tag, b.round, CASE WHEN status = 'CRASH' THEN 'CRASH'
  WHEN place = 1 AND val_bpb IS NOT NULL AND (base IS NULL OR val_bpb < base) THEN 'KEEP' ELSE 'DISCARD' END AS decision
FROM placed p JOIN bases b ON p.tag = b.tag AND p.idx // 4 = b.round""")
def w11(spark, folder):
    rows = x.indexed(experiments(spark, folder)).withColumn("round", F.expr("idx div 4"))
    return x.round_winners(rows, candidate="idx").select("event_id", "tag", "round", "decision")


@query("w12_effort", with_views(EXPERIMENTS) + """
SELECT event_id, idx, idx - lag(idx) OVER (PARTITION BY tag ORDER BY idx) AS took, trim(description) AS description
FROM experiments WHERE status = 'KEEP'""")
def w12(spark, folder):
    rows = x.effort(experiments(spark, folder))
    return rows.select("event_id", "idx", "took", t.strip(F.col("description")).alias("description"))


@query("l1_sorted_deltas", with_views(EXPERIMENTS).rstrip() + DELTAS + """
SELECT event_id, round(delta, 6) AS delta FROM deltas ORDER BY deltas.delta DESC NULLS LAST, event_id""")
def l1(spark, folder):
    rows = x.deltas(experiments(spark, folder)).orderBy(F.desc_nulls_last("delta"), "event_id")
    return rows.select("event_id", F.round("delta", 6).alias("delta"))


@query("l2_first_rows", with_views(EXPERIMENTS) + """
SELECT tag, idx, commit, val_bpb, status FROM experiments ORDER BY tag, idx LIMIT 10""")
def l2(spark, folder):
    # The first ten of (tag, ts, event_id) are found by a top-k over the scan; only those are numbered.
    top = experiments(spark, folder).orderBy("tag", "ts", "event_id").limit(10)
    return order_rows(top, ["tag"], ["ts", "event_id"]).scan(idx=x.number(0)).rows().select(
        "tag", "idx", "commit", "val_bpb", "status"
    )


@query("p27_report_formats", with_views(EXPERIMENTS).rstrip() + DELTAS + """
SELECT event_id, printf('%.6f', val_bpb) AS bpb, printf('%+.6f', delta) AS change,
  format('{:,}', CAST(event_id * 1000 AS BIGINT)) AS grouped FROM deltas WHERE delta IS NOT NULL""")
def p27(spark, folder):
    rows = x.deltas(experiments(spark, folder)).filter("delta is not null")
    return rows.select(
        "event_id",
        t.fixed(F.col("val_bpb")).alias("bpb"),
        t.signed(F.col("delta")).alias("change"),
        t.thousands(F.col("event_id") * 1000).alias("grouped"),
    )


@query("j7_scalar_baseline", with_views(EXPERIMENTS) + """
, base AS (SELECT arg_min(val_bpb, event_id) AS baseline, min(val_bpb) AS best FROM experiments
  WHERE status <> 'CRASH' AND val_bpb IS NOT NULL)
SELECT event_id, val_bpb, round(val_bpb - best, 6) AS over_best FROM experiments, base
WHERE status <> 'CRASH' AND val_bpb <= baseline + 0.0005""")
def j7(spark, folder):
    rows = x.valid(experiments(spark, folder)).filter("val_bpb is not null")
    # One value each, computed once and compared with every row.
    baseline = rows.agg(F.min_by("val_bpb", "event_id")).scalar()
    best = rows.agg(F.min("val_bpb")).scalar()
    near = rows.filter(F.col("val_bpb") <= baseline + F.lit(x.PLOT_SLACK))
    return near.select("event_id", "val_bpb", F.round(F.col("val_bpb") - best, 6).alias("over_best"))
