"""Streaming queries: each reads a table as a stream and is checked with the batch form in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import experiments as x
from tidemark.operators import telemetry as o
from tidemark.plans.staging import staged_path
from tidemark.queries.jobs import WAIT_S
from tidemark.queries.registry import query
from tidemark.queries.views import CORPUS, EXPERIMENTS, JOB_STATES, STAGES, STEP_LOG, with_views
from tidemark.sources import readers, tables
from tidemark.streaming import jobs as j
from tidemark.streaming.incremental import ingest_once, new_files


PIECES = 3


def streamed(spark, rows, at, write):
    """A table that arrives in pieces by time: after each, ``write`` processes what is new in its folder.

    A piece has as many files as Spark writes; the stream goes on from its checkpoint, one micro-batch per piece.
    """
    path = staged_path(spark, "stream")
    low, high = rows.agg(F.min(at), F.max(at)).head()
    piece = F.floor((at - F.lit(low)) / F.lit((high or 0) - (low or 0) + 1) * PIECES)
    for i in range(PIECES):
        rows.filter(piece == i).write.mode("append").parquet(path)
        write(spark.readStream.schema(rows.schema).parquet(path))


def written(spark, rows, at, make, schema):
    """The output of the stream that ``make`` builds on the rows as they arrive."""
    out, progress = staged_path(spark, "streamed"), staged_path(spark, "progress")
    streamed(spark, rows, at, lambda source: j.write_stream(make(source), out, progress))
    return spark.read.schema(schema).parquet(out)


@query("x1_state_changes", with_views(JOB_STATES) + """
, ends AS (SELECT slug, arg_min(event_id, at_us) AS end_id, min(at_us) AS end_us FROM job_states WHERE state IN ('succeeded', 'failed') GROUP BY slug),
lived AS (SELECT j.* FROM job_states j LEFT JOIN ends e ON j.slug = e.slug WHERE state <> '' AND (end_us IS NULL OR at_us < end_us OR event_id = end_id))
SELECT slug, event_id, state FROM (SELECT *, lag(state) OVER (PARTITION BY slug ORDER BY at_us, event_id) AS before FROM lived)
WHERE before IS DISTINCT FROM state""")
def x1(spark, folder):
    rows = tables.job_states(spark, folder)
    return written(spark, rows, F.col("at_us"), j.state_changes, "slug string, event_id bigint, state string")


@query("x2_waiting", with_views(JOB_STATES) + f"""
, begun AS (SELECT slug, min(at_us) AS start_us FROM job_states GROUP BY slug),
seen AS (SELECT j.*, state IN ('succeeded', 'failed') AS ends FROM job_states j JOIN begun b ON j.slug = b.slug
  WHERE at_us <= start_us + {WAIT_S}000000)
SELECT slug, coalesce(arg_min(state, at_us) FILTER (ends),
  CASE WHEN arg_max(state, at_us) = '' THEN '?' ELSE arg_max(state, at_us) END) AS state, NOT bool_or(ends) AS timed_out
FROM seen GROUP BY slug""")
def x2(spark, folder):
    """A last observation of no job moves time on, so that jobs that went silent are reported too."""
    states = tables.job_states(spark, folder)
    clock = states.agg((F.max("at_us") + (WAIT_S + 3_600) * 1_000_000).alias("at_us")).select(
        F.lit("").alias("slug"), "at_us", F.lit(0).cast("bigint").alias("event_id"), F.lit("").alias("state")
    )
    rows = states.select("slug", "at_us", "event_id", "state").unionByName(clock)
    wait = lambda source: j.waited_states(source, WAIT_S)
    return written(spark, rows, F.col("at_us"), wait, "slug string, state string, timed_out boolean").filter("slug <> ''")


@query("x3_run_progress", with_views(STEP_LOG) + """
, lived AS (SELECT * FROM (SELECT *, coalesce(bool_or(loss > 100) OVER (PARTITION BY run_id ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS gone FROM step_log) WHERE NOT gone)
SELECT a.run_id, a.step, round(sum(0.1 * b.loss * pow(0.9, a.step - b.step)) / (1 - pow(0.9, a.step + 1)), 6) AS smooth_loss,
  CAST(coalesce(sum(b.dt_us) FILTER (b.step > 10), 0) AS BIGINT) AS trained, a.loss > 100 AS failed
FROM lived a JOIN lived b ON a.run_id = b.run_id AND b.step <= a.step GROUP BY a.run_id, a.step, a.loss""")
def x3(spark, folder):
    log = tables.step_log(spark, folder).select("run_id", "step", "loss", "dt_us", F.timestamp_seconds(F.col("step") + 86_400).alias("at"))  # after the first watermark, which is time zero
    schema = "run_id bigint, step bigint, smooth_loss double, trained bigint, failed boolean"
    out = written(spark, log, F.col("step"), j.run_progress, schema)
    return out.withColumn("smooth_loss", F.round("smooth_loss", 6))


@query("x4_decisions", with_views(EXPERIMENTS) + """
SELECT tag, event_id, CASE WHEN status = 'CRASH' THEN 'CRASH'
  WHEN val_bpb IS NOT NULL AND (best_before IS NULL OR val_bpb < best_before) THEN 'KEEP' ELSE 'DISCARD' END AS decision
FROM (SELECT *, min(CASE WHEN status <> 'CRASH' THEN val_bpb END) OVER (PARTITION BY tag ORDER BY idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM experiments)""")
def x4(spark, folder):
    ts = F.col("ts").cast("timestamp").alias("ts")
    rows = x.coerce_results(tables.raw_results(spark, folder)).select("tag", ts, "event_id", "val_bpb", "status")
    return written(spark, rows, F.unix_micros("ts"), j.decisions, "tag bigint, event_id bigint, decision string")


@query("x5_metrics_progress", with_views(STAGES) + "SELECT run_id, stage, seconds FROM stages")
def x5(spark, folder):
    marks = tables.stage_events(spark, folder).select("run_id", "stage", "at_us", "edge")
    out, progress = staged_path(spark, "x5"), staged_path(spark, "progress")
    streamed(spark, marks, F.col("at_us"), lambda source: j.write_updates(j.metrics_progress(source), out, progress))
    rows = spark.read.schema("run_id bigint, stage string, seconds double, version int").parquet(out)
    return j.latest_rows(rows, ["run_id", "stage"]).select("run_id", "stage", "seconds")


@query("x5_run_documents", with_views(STAGES) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, stage, seconds FROM stages WHERE seconds IS NOT NULL""")
def x5_documents(spark, folder):
    """The document of each run, replaced whenever marks of it arrive."""
    marks = tables.stage_events(spark, folder).select("run_id", "stage", "at_us", "edge")
    out, progress = staged_path(spark, "runs"), staged_path(spark, "progress")
    stages = ("click", "error", "purchase", "signup", "view")
    streamed(spark, marks, F.col("at_us"), lambda source: j.write_run_documents(j.run_documents(source, stages), out, progress))
    return o.stage_rows(readers.run_documents(spark, out).select(
        readers.document_value("$.run_tag", "string").alias("run_tag"),
        readers.document_value("$.stages", "map<string, double>").alias("stages"),
    ))


@query("x6_ingested_once", with_views(CORPUS) + "SELECT source, count(*) AS n_docs FROM corpus GROUP BY source")
def x6(spark, folder):
    out, progress = staged_path(spark, "x6"), staged_path(spark, "x6-progress")
    for _ in range(2):
        source = new_files(spark, folder, "doc_id bigint, text string, source string", "documents.parquet")
        ingest_once(source, out, progress)
    return spark.read.parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
