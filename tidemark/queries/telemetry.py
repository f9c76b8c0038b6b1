"""Queries over run logs: parsing, step metrics, schedules, smoothing, stages, reports, evaluation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import schedules as s
from tidemark.functions import text as t
from tidemark.operators import evaluation as ev
from tidemark.operators import telemetry as o
from tidemark.queries.corpus import WORDS
from tidemark.queries.registry import query
from tidemark.queries.views import RUN_FACTS, STAGES, STEP_LOG, with_views
from tidemark.functions.text import collapse
from tidemark.operators.corpus import word_counts
from tidemark.sources import tables

BUDGET_US = 500_000_000_000
FLOPS_PER_TOKEN = 5.0e8
STAGE_NAMES = ("click", "error", "purchase", "signup", "view")
SQL_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"


def setting():
    """The number in an event's properties."""
    return F.regexp_extract("props", r"(\d+)", 1).cast("int")


@query("p9_unit_conversions", f"""
SELECT event_id, round_even(mb / 1024, 1) AS gb, round_even(mb * 1048576 / 1073741824, 2) AS gib, mb * 1000 / 1048576 AS mib
FROM (SELECT event_id, CAST({SQL_K} * 37 AS DOUBLE) AS mb FROM events)""")
def p9(spark, folder):
    mb = F.col("mb")
    rows = tables.read(spark, folder, "events").select("event_id", (setting() * 37).cast("double").alias("mb"))
    return rows.select(
        "event_id",
        t.mb_to_gb(mb).alias("gb"),
        t.bytes_to_gib(mb * 1048576).alias("gib"),
        t.bytes_to_mib(mb * 1000).alias("mib"),
    )


@query("p13_summary_lines", with_views(RUN_FACTS) + "SELECT run_id, key, CAST(value AS DOUBLE) AS value FROM summary")
def p13(spark, folder):
    rows = tables.run_log_lines(spark, folder).select("run_id", o.summary_value(F.col("line")).alias("kv"))
    return rows.filter("kv is not null").select("run_id", "kv.key", "kv.value")


@query("p14_step_lines", with_views(STEP_LOG) + """
SELECT run_id, step, CAST(step // 2 AS DOUBLE) AS pct, loss, (step % 10) / 10 AS lrm, dt_us // 1000 AS dt_ms,
  524288000000 // dt_us AS tok_per_sec, step % 50 + 0.5::DOUBLE AS mfu, 1 + step // 50 AS epoch, greatest(0, 300 - step) AS remaining_s
FROM step_log WHERE dt_us > 0""")
def p14(spark, folder):
    return o.step_lines(tables.raw_step_lines(spark, folder))


@query("p15_gpu_snapshots", f"""
SELECT event_id, event_type <> 'error' AS parsed, CASE WHEN event_type <> 'error' THEN 'Accelerator A' END AS name,
  CASE WHEN event_type <> 'error' THEN CAST({SQL_K} * 100 AS DOUBLE) END AS used,
  CASE WHEN event_type <> 'error' THEN CAST({SQL_K} AS DOUBLE) END AS busy FROM events""")
def p15(spark, folder):
    rows = tables.gpu_lines(spark, folder).select("event_id", o.gpu_snapshot(F.col("line")).alias("g"))
    return rows.select(
        "event_id",
        F.col("g").isNotNull().alias("parsed"),
        F.col("g.name").alias("name"),
        F.col("g.memory_used").alias("used"),
        F.col("g.utilization").alias("busy"),
    )


@query("p16_step_metrics", with_views(STEP_LOG) + f"""
SELECT run_id, step, CAST(trunc(524288.0::DOUBLE / (dt_us / 1e6)) AS BIGINT) AS tok_per_sec,
  round(100.0::DOUBLE * {FLOPS_PER_TOKEN} * 524288.0::DOUBLE / (dt_us / 1e6) / 989.5e12, 6) AS mfu,
  round(greatest(0.0, 300.0::DOUBLE - step * 2.5), 4) AS remaining FROM step_log WHERE dt_us > 0""")
def p16(spark, folder):
    seconds = F.col("dt_us") / F.lit(1e6)
    rows = tables.step_log(spark, folder).filter("dt_us > 0")
    return rows.select(
        "run_id",
        "step",
        s.tokens_per_second(seconds).alias("tok_per_sec"),
        F.round(s.utilisation(seconds, F.lit(FLOPS_PER_TOKEN)), 6).alias("mfu"),
        F.round(s.remaining(F.col("step") * 2.5), 4).alias("remaining"),
    )


@query("p17_schedules", with_views(STEP_LOG) + """
, placed AS (SELECT run_id, step, least(step / 64, 1.0) AS done FROM step_log)
SELECT run_id, step, round(CASE WHEN done < 0.125 THEN done / 0.125 WHEN done < 0.5 THEN 1.0
    ELSE (1 - done) / 0.5 + (1 - (1 - done) / 0.5) * 0.1 END, 6) AS lr,
  round((1 - least(step / 300, 1.0)) * 0.85 + least(step / 300, 1.0) * 0.95, 6) AS momentum,
  round(0.2 * (1 - done), 6) AS decay FROM placed""")
def p17(spark, folder):
    done = s.progress(F.col("step"), 64.0)
    return tables.step_log(spark, folder).select(
        "run_id",
        "step",
        F.round(s.lr_multiplier(done, warmup=0.125, warmdown=0.5, final=0.1), 6).alias("lr"),
        F.round(s.momentum(F.col("step")), 6).alias("momentum"),
        F.round(s.weight_decay(done), 6).alias("decay"),
    )


@query("p18_diverged", """
SELECT event_id, value > 100 OR event_id % 97 = 0 AS diverged FROM events""")
def p18(spark, folder):
    loss = F.when(F.col("event_id") % 97 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return tables.read(spark, folder, "events").select("event_id", s.diverged(loss).alias("diverged"))


@query("p22_sweep_settings", f"""
WITH runs AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'generic' WHEN 'purchase' THEN 'domain' ELSE 'other' END AS mode,
  CASE WHEN {SQL_K} % 3 = 0 THEN {SQL_K} END AS own FROM events)
SELECT event_id, mode, mode <> 'other' AS known_mode,
  CASE mode WHEN 'generic' THEN coalesce(own, 8) WHEN 'domain' THEN coalesce(own, 32) END AS r,
  CASE mode WHEN 'generic' THEN 2e-4 WHEN 'domain' THEN 5e-4 END AS learning_rate FROM runs""")
def p22(spark, folder):
    mode = F.when(F.col("event_type") == "signup", "Generic").when(F.col("event_type") == "purchase", "DOMAIN").otherwise("other")
    rows = tables.read(spark, folder, "events").select("event_id", mode.alias("mode"), F.when(setting() % 3 == 0, setting()).alias("own"))
    return o.sweep_settings(rows, F.col("mode"), F.col("own"), F.lit(None).cast("double")).drop("own")


@query("p25_timestamps", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, epoch_us(ts) AS epoch_us, strftime(ts, '%H:%M:%S') AS clock FROM events""")
def p25(spark, folder):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    rows = tables.read(spark, folder, "events").select("event_id", F.to_timestamp(iso).alias("at"))
    return rows.select(
        "event_id",
        F.unix_seconds("at").alias("epoch_s"),
        F.unix_micros("at").alias("epoch_us"),
        F.date_format("at", "HH:mm:ss").alias("clock"),
    )


@query("p26_duration_text", with_views(STEP_LOG) + """
SELECT run_id, step, printf('%dm %02ds', (dt_us // 1000000) // 60, (dt_us // 1000000) % 60) AS took FROM step_log""")
def p26(spark, folder):
    seconds = F.col("dt_us") / F.lit(1e6)
    return tables.step_log(spark, folder).select("run_id", "step", t.duration_text(seconds).alias("took"))


@query("p28_stage_rows", with_views(STAGES) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, stage, seconds FROM stages WHERE seconds IS NOT NULL""")
def p28(spark, folder):
    docs = o.metrics_json(o.stage_durations(tables.stage_events(spark, folder)), STAGE_NAMES)
    parsed = F.from_json("document", "run_tag string, stages map<string, double>")
    return o.stage_rows(docs.select(parsed.alias("d")).select("d.*"))


@query("a10_run_summaries", with_views(RUN_FACTS) + """
SELECT run_id, best AS val_bpb, (timed_us // 100000) / 10 AS training_seconds, (all_us // 100000) / 10 AS total_seconds,
  steps * 100 + 0.5::DOUBLE AS peak_vram_mb, CAST(steps AS DOUBLE) AS num_steps, 8.0::DOUBLE AS depth FROM runs""")
def a10(spark, folder):
    rows = o.run_summaries(tables.run_log_lines(spark, folder))
    return rows.drop("mfu_percent", "total_tokens_M", "num_params_M")


@query("a11_run_totals", with_views(RUN_FACTS) + f"""
, used AS (SELECT *, 100.0::DOUBLE * {FLOPS_PER_TOKEN}::DOUBLE * 524288.0::DOUBLE / 989.5e12 AS rate FROM runs)
SELECT run_id, steps, CAST(timed_us AS BIGINT) AS timed_us, steps * 524288 AS total_tokens,
  round(CASE WHEN timed_us > 0 THEN rate * (steps - 10) / (timed_us / 1e6) ELSE 0 END, 9) AS mfu,
  round(CASE WHEN timed_us > 0 THEN rate * (steps - 11) / (timed_us / 1e6) ELSE 0 END, 9) AS mfu_corrected FROM used""")
def a11(spark, folder):
    rows = o.run_totals(tables.step_log(spark, folder), FLOPS_PER_TOKEN)
    return rows.withColumns({"mfu": F.round("mfu", 9), "mfu_corrected": F.round("mfu_corrected", 9)})


@query("a12_loss_trajectory", with_views(STEP_LOG) + """
, seen AS (SELECT * FROM step_log WHERE step % 5 <> 0)
SELECT run_id, max(loss) FILTER (step = lo) AS first_loss, max(loss) FILTER (step = hi) AS last_loss
FROM (SELECT *, min(step) OVER (PARTITION BY run_id) AS lo, max(step) OVER (PARTITION BY run_id) AS hi FROM seen) GROUP BY run_id""")
def a12(spark, folder):
    log = tables.step_log(spark, folder)
    rows = o.loss_trajectory(log.withColumn("loss", F.when(F.col("step") % 5 != 0, F.col("loss"))))
    return rows.filter("first_loss is not null")


@query("a13_stage_durations", with_views(STAGES) + """
SELECT run_id, stage, seconds, round(sum(seconds) OVER (PARTITION BY run_id), 2) AS total_wall_sec FROM stages""")
def a13(spark, folder):
    stages = o.stage_durations(tables.stage_events(spark, folder))
    return stages.join(o.wall_total(stages), "run_id")


@query("a14_peak_memory", f"""
SELECT user_id AS run_id, round_even(max(CASE WHEN event_type <> 'error' THEN {SQL_K} * 100 END) / 1024, 1) AS peak_gb
FROM events GROUP BY user_id""")
def a14(spark, folder):
    rows = o.peak_memory(tables.gpu_lines(spark, folder), o.gpu_snapshot(F.col("line"))["memory_used"])
    return rows.select("run_id", t.mb_to_gb(F.col("peak")).alias("peak_gb"))


@query("a16_run_report", with_views(STAGES, RUN_FACTS) + f"""
, peaks AS (SELECT user_id AS run_id, max(CASE WHEN event_type <> 'error' THEN {SQL_K} * 100.0::DOUBLE END) AS peak FROM events GROUP BY 1)
SELECT s.run_id, stage, seconds, total_wall_sec, peak, steps, best FROM stages s
JOIN (SELECT run_id, round(sum(seconds), 2) AS total_wall_sec FROM stages GROUP BY run_id) w ON s.run_id = w.run_id
LEFT JOIN peaks p ON s.run_id = p.run_id LEFT JOIN runs r ON s.run_id = r.run_id""")
def a16(spark, folder):
    stages = o.stage_durations(tables.stage_events(spark, folder))
    peaks = o.peak_memory(tables.gpu_lines(spark, folder), o.gpu_snapshot(F.col("line"))["memory_used"])
    steps = tables.step_log(spark, folder).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"), F.min("loss").alias("best")
    )
    return o.run_report(stages, peaks, steps)


@query("w5_training_progress", with_views(STEP_LOG) + f"""
SELECT run_id, step, CAST(trained AS BIGINT) AS trained_us, round(least(trained / {BUDGET_US}, 1.0), 6) AS progress FROM (
  SELECT *, coalesce(sum(CASE WHEN step > 10 THEN dt_us END) OVER (PARTITION BY run_id ORDER BY step
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS trained FROM step_log)""")
def w5(spark, folder):
    rows = o.trained_before(tables.step_log(spark, folder))
    done = s.progress(F.col("trained"), BUDGET_US)
    return rows.select("run_id", "step", F.col("trained").alias("trained_us"), F.round(done, 6).alias("progress"))


@query("w6_until_budget", with_views(STEP_LOG) + f"""
, totals AS (SELECT run_id, step, sum(CASE WHEN step > 10 THEN dt_us ELSE 0 END) OVER (PARTITION BY run_id ORDER BY step) AS total
  FROM step_log),
stops AS (SELECT run_id, min(step) AS stop FROM totals WHERE step >= 10 AND total >= {BUDGET_US} GROUP BY run_id)
SELECT t.run_id, t.step FROM totals t LEFT JOIN stops s ON t.run_id = s.run_id WHERE stop IS NULL OR step <= stop""")
def w6(spark, folder):
    return o.until_budget(tables.step_log(spark, folder), BUDGET_US).select("run_id", "step")


@query("w7_smoothed_loss", with_views(STEP_LOG) + """
SELECT a.run_id, a.step, round(sum(0.1 * b.loss * pow(0.9, a.step - b.step)) / (1 - pow(0.9, a.step + 1)), 6) AS smooth_loss
FROM step_log a JOIN step_log b ON a.run_id = b.run_id AND b.step <= a.step GROUP BY a.run_id, a.step""")
def w7(spark, folder):
    rows = o.smoothed_loss(tables.step_log(spark, folder))
    return rows.select("run_id", "step", F.round("smooth_loss", 6).alias("smooth_loss"))


@query("w8_until_diverged", with_views(STEP_LOG) + """
SELECT run_id, step, loss FROM (SELECT *, coalesce(bool_or(loss > 100) OVER (PARTITION BY run_id ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS gone FROM step_log) WHERE NOT gone""")
def w8(spark, folder):
    return o.until_diverged(tables.step_log(spark, folder)).select("run_id", "step", "loss")


@query("j4_compared_responses", """
SELECT conv_id AS prompt_idx, max(text) FILTER (turn = 1) AS before, max(text) FILTER (turn = 3) AS middle,
  max(text) FILTER (turn = 5) AS after,
  max(text) FILTER (turn = 1) IS DISTINCT FROM max(text) FILTER (turn = 5) AS changed
FROM conversations WHERE turn IN (1, 3, 5) GROUP BY conv_id""")
def j4(spark, folder):
    phase = F.when(F.col("turn") == 1, "before").when(F.col("turn") == 3, "middle").when(F.col("turn") == 5, "after")
    samples = tables.turns(spark, folder).select(
        F.col("conv_id").alias("prompt_idx"), phase.alias("phase"), F.col("text").alias("response")
    )
    return o.compared(samples.filter("phase is not null"), ("before", "middle", "after"))


# --------------------------------------------------------------------------- evaluation


@query("a1_bits_per_byte", with_views(WORDS) + """
, counts AS (SELECT shard, word, count(*) AS cnt FROM (SELECT shard, unnest(w) AS word FROM words) GROUP BY shard, word),
losses AS (SELECT *, -ln(cnt / sum(cnt) OVER (PARTITION BY shard)) AS nats,
  CASE WHEN word = ' ' THEN 0 ELSE strlen(word) END AS n_bytes FROM counts)
SELECT shard, CAST(sum(n_bytes * cnt) AS BIGINT) AS n_bytes,
  round(sum(nats * cnt) FILTER (n_bytes > 0) / (ln(2) * sum(n_bytes * cnt)), 6) AS bpb FROM losses GROUP BY shard""")
def a1(spark, folder):
    counts = word_counts(tables.texts(spark, folder), collapse(F.col("text")), by=("shard",))
    totals = counts.groupBy("shard").agg(F.sum("cnt").alias("total"))
    # A lone blank stands for a special token: it has no bytes and counts in neither sum.
    rows = counts.join(totals, "shard").select(
        "shard",
        "cnt",
        (-F.log(F.col("cnt") / F.col("total"))).alias("nats"),
        F.when(F.col("word") == " ", 0).otherwise(F.octet_length("word")).alias("n_bytes"),
    )
    out = ev.bits_per_byte(rows, F.col("nats"), F.col("n_bytes"), by=("shard",), weight=F.col("cnt"))
    return out.select("shard", "n_bytes", F.round("bpb", 6).alias("bpb"))


LOSSES = """WITH capped AS (SELECT vec_id, CASE WHEN vec_id % 7 = 3 THEN -1 ELSE label END AS target,
  list_transform(embedding, lambda x: 15.0::DOUBLE * tanh(20 * CAST(x AS DOUBLE) / 15.0::DOUBLE)) AS z FROM embeddings),
losses AS (SELECT vec_id, target, CASE WHEN target <> -1 THEN
  ln(list_sum(list_transform(z, lambda v: exp(v)))) - z[target + 1] END AS loss FROM capped)
"""


def logits(spark, folder):
    return tables.read(spark, folder, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: F.lit(20) * x.cast("double")).alias("logits"),
        F.when(F.col("vec_id") % 7 == 3, -1).otherwise(F.col("label")).alias("target"),
    )


@query("a2_cross_entropy", LOSSES + "SELECT vec_id, target, round(loss, 6) AS loss FROM losses")
def a2(spark, folder):
    loss = ev.cross_entropy(F.col("logits"), F.col("target"))
    return logits(spark, folder).select("vec_id", "target", F.round(loss, 6).alias("loss"))


def capped_model():
    """A caller's model for the scoring query: the same capped loss in numpy."""

    def model(logits: pd.Series, target: pd.Series) -> pd.Series:
        z = 15.0 * np.tanh(np.stack(logits.to_numpy()) / 15.0)
        at = target.to_numpy()
        loss = np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), np.maximum(at, 0)]
        return pd.Series(loss).astype("Float64").mask(at < 0)

    return model


@query("f5_scored_by_model", LOSSES + """
SELECT target, round(avg(loss), 6) AS mean_loss, count(loss) AS n_targets FROM losses GROUP BY target""")
def f5(spark, folder):
    rows = ev.scored(logits(spark, folder), capped_model(), "logits", "target")
    out = ev.mean_loss(rows, F.col("loss"), by=("target",))
    return out.withColumn("mean_loss", F.round("mean_loss", 6))
