"""Queries over job records: names, states, tails, roll-ups, matching, cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import experiments as x
from tidemark.operators import jobs as o
from tidemark.queries.registry import query
from tidemark.queries.views import EXPERIMENTS, JOB_STATES, RUN_FACTS, STEP_LOG, with_views
from tidemark.sources import readers, tables

LOOKED_UP = "view-42"
WAIT_S = 500_000


@query("p10_job_names", """
SELECT page_id, 'research-' || regexp_replace(regexp_replace(lower(url), '[^a-z0-9-]', '-', 'g'), '^-+|-+$', '', 'g')
  || '-' || substr(md5(url), 1, 7) AS job_name FROM pages""")
def p10(spark, folder):
    pages = tables.read(spark, folder, "pages").select("page_id", "url")
    branch = F.concat(F.lit("research/"), "url")
    return pages.select("page_id", t.job_name(branch, F.substring(F.md5("url"), 1, 7)).alias("job_name"))


def candidate_names(spark, folder):
    rows = x.indexed(x.coerce_results(tables.raw_results(spark, folder)))
    rows = rows.withColumns({"round": F.expr("idx div 4"), "candidate": F.expr("idx % 4 + 1")})
    name = F.when(F.col("idx") % 9 == 8, F.concat(F.lit("other-"), "commit")).otherwise(
        F.format_string("research-t%d-r%d-%d-%s", "tag", "round", "candidate", "commit")
    )
    return rows.withColumn("name", name)


NAMES = EXPERIMENTS + """,
named AS (SELECT *, idx // 4 AS round, idx % 4 + 1 AS candidate, idx % 9 = 8 AS other FROM experiments)"""


@query("p11_parsed_names", with_views(NAMES) + """
SELECT event_id, CASE WHEN NOT other THEN 't' || tag END AS tag, CASE WHEN NOT other THEN round END AS round,
  CASE WHEN NOT other THEN candidate END AS candidate, CASE WHEN NOT other THEN commit END AS commit FROM named""")
def p11(spark, folder):
    rows = candidate_names(spark, folder).select("event_id", t.parse_job_name(F.col("name")).alias("p"))
    return rows.select("event_id", "p.tag", "p.round", "p.candidate", "p.commit")


@query("p12_branch_guard", """
SELECT page_id, page_id % 5 <> 0 AS accepted FROM pages""")
def p12(spark, folder):
    branch = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("main/"), "url")).otherwise(F.concat(F.lit("research/"), "url"))
    return tables.read(spark, folder, "pages").select("page_id", t.on_branch(branch).alias("accepted"))


@query("s16_first_named_job", f"""
SELECT coalesce((SELECT 'job-' || event_id FROM events WHERE event_type || '-' || regexp_extract(props, '([0-9]+)', 1) = '{LOOKED_UP}'
  ORDER BY event_id LIMIT 1), '') AS slug""")
def s16(spark, folder):
    return o.first_named(tables.job_list(spark, folder), LOOKED_UP)


@query("s17_log_tail", with_views(RUN_FACTS) + """
SELECT 'job-' || run_id AS slug, line_no, line FROM log_lines WHERE line_no > 9 - 4""")
def s17(spark, folder):
    return o.log_tail(tables.run_log_lines(spark, folder).select("slug", "line_no", "line"), 4)


@query("l3_tail_per_group", with_views(EXPERIMENTS) + """
SELECT tag, event_id FROM (SELECT tag, event_id, row_number() OVER (PARTITION BY tag ORDER BY event_id DESC) AS n FROM experiments)
WHERE n <= 20""")
def l3(spark, folder):
    return o.log_tail(tables.raw_results(spark, folder).select("tag", "event_id"), 20, slug="tag", order="event_id")


@query("w9_state_changes", with_views(JOB_STATES) + """
SELECT slug, event_id, state FROM (
  SELECT *, lag(state) OVER (PARTITION BY slug ORDER BY at_us, event_id) AS before FROM job_states WHERE state <> '')
WHERE before IS DISTINCT FROM state""")
def w9(spark, folder):
    return o.state_changes(tables.job_states(spark, folder)).select("slug", "event_id", "state")


@query("w9_state_changes_unknown", with_views(JOB_STATES) + """
SELECT slug, event_id, state FROM (
  SELECT slug, event_id, shown AS state, lag(shown) OVER (PARTITION BY slug ORDER BY at_us, event_id) AS before
  FROM (SELECT *, CASE state WHEN '' THEN '?' ELSE state END AS shown FROM job_states))
WHERE before IS DISTINCT FROM state""")
def w9_unknown(spark, folder):
    return o.state_changes(tables.job_states(spark, folder), show_unknown=True).select("slug", "event_id", "state")


@query("w9_until_terminal", with_views(JOB_STATES) + """
, ends AS (SELECT slug, arg_min(event_id, at_us) AS end_id, min(at_us) AS end_us FROM job_states WHERE state IN ('succeeded', 'failed') GROUP BY slug)
SELECT j.slug, event_id, state FROM job_states j LEFT JOIN ends e ON j.slug = e.slug
WHERE end_us IS NULL OR at_us < end_us OR event_id = end_id""")
def w9_terminal(spark, folder):
    return o.until_terminal(tables.job_states(spark, folder)).select("slug", "event_id", "state")


LATEST = JOB_STATES + """,
latest AS (SELECT slug, CASE WHEN state = '' THEN '?' ELSE state END AS state FROM (
  SELECT *, row_number() OVER (PARTITION BY slug ORDER BY at_us DESC, event_id DESC) AS n FROM job_states) WHERE n = 1)"""


@query("j2_job_report", with_views(LATEST, RUN_FACTS) + """
, tails AS (SELECT 'job-' || run_id AS slug, line_no, line FROM log_lines)
SELECT t.slug, line_no, line, state FROM tails t JOIN latest l ON t.slug = l.slug
WHERE state <> 'succeeded' OR line_no BETWEEN 2 AND 8""")
def j2(spark, folder):
    lines = tables.run_log_lines(spark, folder).select("slug", "line_no", "line")
    return o.job_report(tables.job_states(spark, folder), lines)


@query("j3_candidate_jobs", with_views(NAMES) + """
SELECT event_id, 't' || tag AS tag, round, candidate, commit, val_bpb FROM named WHERE NOT other""")
def j3(spark, folder):
    rows = candidate_names(spark, folder)
    branches = rows.select(
        "event_id", F.concat(F.lit("t"), F.col("tag").cast("string")).alias("tag"), "round", "candidate"
    )
    summaries = rows.select(t.parse_job_name(F.col("name")).alias("p"), "val_bpb").filter("p is not null").select("p.*", "val_bpb")
    return branches.join(summaries, ["tag", "round", "candidate"]).select(
        "event_id", "tag", "round", "candidate", "commit", "val_bpb"
    )


@query("a20_failed_jobs", with_views(LATEST) + """
SELECT slug, state, (SELECT count(*) FROM latest WHERE state <> 'succeeded') AS n_failed FROM latest WHERE state <> 'succeeded'""")
def a20(spark, folder):
    return o.failed_jobs(o.latest_states(tables.job_states(spark, folder)))


@query("a20_rollup", with_views(LATEST) + """
SELECT bool_and(state = 'succeeded') AS all_ok, count(*) FILTER (state <> 'succeeded') AS n_failed,
  count(*) FILTER (state NOT IN ('succeeded', 'failed', 'terminated', 'cancelled')) AS n_pending FROM latest""")
def a20_rollup(spark, folder):
    return o.rollup(o.latest_states(tables.job_states(spark, folder)))


@query("x2_waited_states", with_views(JOB_STATES) + f"""
, begun AS (SELECT slug, min(at_us) AS start_us FROM job_states GROUP BY slug),
seen AS (SELECT j.*, state IN ('succeeded', 'failed') AS ends FROM job_states j JOIN begun b ON j.slug = b.slug
  WHERE at_us <= start_us + {WAIT_S}000000)
SELECT slug, coalesce(arg_min(state, at_us) FILTER (ends),
  CASE WHEN arg_max(state, at_us) = '' THEN '?' ELSE arg_max(state, at_us) END) AS state, NOT bool_or(ends) AS timed_out
FROM seen GROUP BY slug""")
def x2_batch(spark, folder):
    return o.waited_states(tables.job_states(spark, folder), WAIT_S)


PRICES = (("A", 2.39), ("B", 1.55))
RUNS = STEP_LOG + """,
runs AS (SELECT run_id, CASE WHEN run_id % 2 = 0 THEN 'A' ELSE 'B' END AS gpu, sum(dt_us) / 1e6 AS duration_s FROM step_log GROUP BY run_id),
prices AS (SELECT * FROM (VALUES ('A', 2.39::DOUBLE), ('B', 1.55::DOUBLE)) p(gpu, usd_per_hr)),
priced AS (SELECT *, duration_s / 3600 * usd_per_hr AS cost_usd FROM runs JOIN prices USING (gpu))"""


def priced_runs(spark, folder):
    gpu = F.when(F.col("run_id") % 2 == 0, "A").otherwise("B")
    runs = tables.step_log(spark, folder).groupBy("run_id").agg((F.sum("dt_us") / F.lit(1e6)).alias("duration_s"))
    prices = readers.table_of(spark, PRICES, "gpu string, usd_per_hr double")
    return o.priced(runs.withColumn("gpu", gpu), prices)


@query("j6_run_prices", with_views(RUNS) + "SELECT run_id, gpu, usd_per_hr, round(cost_usd, 4) AS cost_usd FROM priced")
def j6(spark, folder):
    return priced_runs(spark, folder).select("run_id", "gpu", "usd_per_hr", F.round("cost_usd", 4).alias("cost_usd"))


@query("a18_cost_totals", with_views(RUNS) + """
SELECT gpu, count(*) AS runs, round(sum(cost_usd), 2) AS total_usd, round(avg(cost_usd), 4) AS mean_usd FROM priced GROUP BY gpu""")
def a18(spark, folder):
    return priced_runs(spark, folder).groupBy("gpu").agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.sum("cost_usd"), 2).alias("total_usd"),
        F.round(F.avg("cost_usd"), 4).alias("mean_usd"),
    )


@query("a19_throughput", with_views(RUNS) + """
SELECT count(*) AS runs, round(3600 / avg(duration_s), 8) AS per_hour FROM runs""")
def a19(spark, folder):
    runs = tables.step_log(spark, folder).groupBy("run_id").agg((F.sum("dt_us") / F.lit(1e6)).alias("wall_s"))
    return o.throughput(runs).withColumn("per_hour", F.round("per_hour", 8))


@query("a19_phase_shares", """
SELECT event_type AS phase, round(sum(value), 2) AS seconds, round(sum(value) / (SELECT sum(value) FROM events), 6) AS share
FROM events GROUP BY event_type""")
def a19_phases(spark, folder):
    rows = tables.read(spark, folder, "events").select(F.col("event_type").alias("phase"), F.col("value").alias("seconds"))
    out = o.phase_shares(rows)
    return out.withColumns({"seconds": F.round("seconds", 2), "share": F.round("share", 6)})
