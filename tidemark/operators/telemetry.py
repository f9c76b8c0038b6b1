"""Run telemetry: log parsing, step metrics, smoothed loss, stage timings, run reports and sweeps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import schedules as s
from tidemark.plans.ordered import number, order_rows, previous, running_any, running_sum
from tidemark.schemas import GPU_SNAPSHOT

# Keys of the run summary block and the fields of a step line.
SUMMARY_KEYS = (
    "val_bpb", "training_seconds", "total_seconds", "peak_vram_mb", "mfu_percent", "total_tokens_M", "num_steps",
    "num_params_M", "depth",
)
REPORT_KEYS = SUMMARY_KEYS + ("num_tokens_M",)
SUMMARY_MARK = "---"
STEP_FIELDS = {
    "step": (r"step (\d+)", "bigint"),
    "pct": (r"\(([0-9.]+)%\)", "double"),
    "loss": (r"loss: ([-0-9.a-z]+)", "double"),
    "lrm": (r"lrm: ([0-9.]+)", "double"),
    "dt_ms": (r"dt: (\d+)ms", "bigint"),
    "tok_per_sec": (r"tok/sec: ([0-9,]+)", "bigint"),
    "mfu": (r"mfu: ([0-9.]+)%", "double"),
    "epoch": (r"epoch: (\d+)", "bigint"),
    "remaining_s": (r"remaining: (\d+)s", "bigint"),
}
# Adapter rank and learning rate by training mode.
MODE_DEFAULTS = {"generic": (8, 2e-4), "domain": (32, 5e-4)}


# --------------------------------------------------------------------------- logs


def summary_value(line: Column) -> Column:
    """Key and value of a summary line, null for any other line."""
    form = rf"^({'|'.join(SUMMARY_KEYS)}):\s+([-0-9.]+)"
    return F.when(
        line.rlike(form),
        F.struct(
            F.regexp_extract(line, form, 1).alias("key"),
            F.regexp_extract(line, form, 2).try_cast("double").alias("value"),
        ),
    )


def is_report_line(line: Column) -> Column:
    """Lines shown of a job that succeeded."""
    return line.rlike("|".join(f"{key}:" for key in REPORT_KEYS) + f"|^{SUMMARY_MARK}")


def run_summaries(lines: DataFrame, run: str = "run_id", line: str = "line") -> DataFrame:
    """Key/value lines of each run as one row with a column per key."""
    values = lines.select(run, summary_value(F.col(line)).alias("kv")).filter("kv is not null")
    columns = [F.max(F.when(F.col("kv.key") == key, F.col("kv.value"))).alias(key) for key in SUMMARY_KEYS]
    return values.groupBy(run).agg(*columns)


def step_lines(raw: DataFrame, run: str = "run_id", line: str = "line") -> DataFrame:
    """Step telemetry from raw log lines, in which many updates may follow each other, separated by returns."""
    updates = raw.select(run, F.explode(F.split(line, r"[\r\n]+")).alias("_u")).filter(F.col("_u").startswith("step "))
    fields = [
        F.regexp_replace(F.regexp_extract("_u", form, 1), ",", "").try_cast(kind).alias(name)
        for name, (form, kind) in STEP_FIELDS.items()
    ]
    return updates.select(run, *fields)


def gpu_snapshot(line: Column) -> Column:
    """Fields of a GPU snapshot line; null when the line is something else, such as an error."""
    parsed = F.from_csv(line, F.lit(GPU_SNAPSHOT), {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true"})
    return F.when(parsed["memory_used"].isNotNull(), parsed)


# --------------------------------------------------------------------------- steps


def timed(step: Column, dt: Column) -> Column:
    """Step time that counts as training: the first steps compile and are left out."""
    return F.when(step > s.UNTIMED_STEPS, dt)


def trained_before(log: DataFrame, run: str = "run_id", step: str = "step", dt: str = "dt_us") -> DataFrame:
    """Training time of each run before each step."""
    done = running_sum(timed(F.col(step), F.col(dt)), inclusive=False)
    return order_rows(log, [run], [step]).scan(trained=done).rows()


def until_budget(log: DataFrame, budget: int, run: str = "run_id", step: str = "step", dt: str = "dt_us") -> DataFrame:
    """Steps up to the one at which the training time reaches the budget, never stopping among the untimed steps.

    Training time never falls, so a run is over before a step exactly when it was over at the step before it.
    """
    done = running_sum(timed(F.col(step), F.col(dt)), inclusive=False)
    rows = order_rows(log, [run], [step]).scan(trained=done, last_step=previous(step)).rows()
    over = (F.col("last_step") >= s.UNTIMED_STEPS) & (F.col("trained") >= budget)
    return rows.filter(~F.coalesce(over, F.lit(False))).drop("last_step")


def until_diverged(log: DataFrame, run: str = "run_id", step: str = "step", loss: str = "loss") -> DataFrame:
    """Steps up to and including the first one that diverged."""
    gone = running_any(s.diverged(F.col(loss)), inclusive=False)
    return order_rows(log, [run], [step]).scan(gone=gone).rows().filter("not gone").drop("gone")


def smoothed_loss(
    log: DataFrame,
    run: str = "run_id",
    step: str = "step",
    loss: str = "loss",
    beta: float = s.EMA_BETA,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Exponential mean of the loss of each run, corrected for its start.

    The mean is a recursion. Inside a block of steps it is a weighted running sum, so a window over (run, block)
    gives it; blocks are short enough for the weights to stay in range. What a block receives is the same recursion
    over block totals, again in short groups. What a group receives from before the last group is weighted below
    1e-180 and vanishes in double precision. No task ever holds more than one block of a run.

    ``carried`` (run, ema, seen) continues runs of which ``seen`` steps went before. The result has the uncorrected
    mean as ``ema`` and the number of steps so far as ``seen``.
    """
    block = max(1, min(256, int(math.log(1e12) / -math.log(beta))))
    across = beta**block
    group = max(1, int(math.log(1e-187) / math.log(across)))
    rows = order_rows(log, [run], [step]).scan(_n=number(0)).settled()
    rows = rows.withColumns({"_b": F.floor(F.col("_n") / block).cast("bigint"), "_j": F.col("_n") % block})
    share = (1 - beta) * F.col(loss)

    totals = rows.groupBy(run, "_b").agg(
        F.sum(share * F.pow(F.lit(beta), F.lit(block - 1) - F.col("_j"))).alias("_total")
    )
    totals = totals.withColumns({"_g": F.floor(F.col("_b") / group).cast("bigint"), "_r": F.col("_b") % group})
    in_group = Window.partitionBy(run, "_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    weighted = F.sum(F.col("_total") * F.pow(F.lit(across), -F.col("_r"))).over(in_group)
    totals = totals.withColumn("_end", F.pow(F.lit(across), F.col("_r")) * weighted)
    group_end = totals.groupBy(run, (F.col("_g") + 1).alias("_g")).agg(F.max_by("_end", "_b").alias("_from"))
    totals = totals.join(group_end, [run, "_g"], "left")
    faded_in = F.pow(F.lit(across), F.col("_r") + 1) * F.coalesce("_from", F.lit(0.0))
    entering = totals.select(run, (F.col("_b") + 1).alias("_b"), (F.col("_end") + faded_in).alias("_enter"))

    in_block = Window.partitionBy(run, "_b").orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    local = F.pow(F.lit(beta), F.col("_j")) * F.sum(share * F.pow(F.lit(beta), -F.col("_j"))).over(in_block)
    rows = rows.withColumn("_local", local).join(entering, [run, "_b"], "left")
    smooth = F.col("_local") + F.pow(F.lit(beta), F.col("_j") + 1) * F.coalesce("_enter", F.lit(0.0))
    rows = rows.withColumns({"ema": smooth, "seen": F.col("_n") + 1}).drop("_n", "_b", "_j", "_local", "_enter")
    if carried is not None:
        past = carried.select(run, F.col("ema").alias("_ema"), F.col("seen").alias("_seen"))
        rows = rows.join(past, run, "left")
        faded = F.pow(F.lit(beta), F.col("seen")) * F.coalesce("_ema", F.lit(0.0))
        seen = F.col("seen") + F.coalesce("_seen", F.lit(0))
        rows = rows.withColumns({"ema": F.col("ema") + faded, "seen": seen}).drop("_ema", "_seen")
    return rows.withColumn("smooth_loss", F.col("ema") / (F.lit(1.0) - F.pow(F.lit(beta), F.col("seen"))))


def run_totals(
    log: DataFrame, flops_per_token: float, run: str = "run_id", tokens: int = s.TOKENS_PER_STEP, peak: float = s.PEAK_FLOPS
) -> DataFrame:
    """Steps, tokens, training time and steady use of the peak rate of each run.

    ``mfu`` counts ten untimed steps although eleven are left out of the time; ``mfu_corrected`` counts eleven.
    """
    out = log.groupBy(run).agg(
        F.count(F.lit(1)).alias("steps"), F.coalesce(F.sum(timed(F.col("step"), F.col("dt_us"))), F.lit(0)).alias("timed_us")
    )
    rate = F.lit(100.0 * flops_per_token * tokens / peak)
    seconds = F.col("timed_us") / F.lit(1e6)

    def use(untimed: int) -> Column:
        return F.when(F.col("timed_us") > 0, rate * (F.col("steps") - untimed) / seconds).otherwise(F.lit(0.0))

    return out.withColumns(
        {
            "total_tokens": F.col("steps") * tokens,
            "mfu": use(s.UNTIMED_STEPS),
            "mfu_corrected": use(s.UNTIMED_STEPS + 1),
        }
    )


def loss_trajectory(log: DataFrame, run: str = "run_id", step: str = "step", loss: str = "loss") -> DataFrame:
    """First and last logged loss of each run; steps without one are skipped."""
    at = F.when(F.col(loss).isNotNull(), F.col(step))
    return log.groupBy(run).agg(F.min_by(loss, at).alias("first_loss"), F.max_by(loss, at).alias("last_loss"))


# --------------------------------------------------------------------------- stages and reports


def stage_durations(events: DataFrame, run: str = "run_id") -> DataFrame:
    """Seconds of each stage from its start and end events (run, stage, edge, at_us), rounded to two digits."""
    out = events.groupBy(run, "stage").agg(
        F.min(F.when(F.col("edge") == "start", F.col("at_us"))).alias("_from"),
        F.max(F.when(F.col("edge") == "end", F.col("at_us"))).alias("_to"),
    )
    return out.select(run, "stage", F.round((F.col("_to") - F.col("_from")) / F.lit(1e6), 2).alias("seconds"))


def wall_total(stages: DataFrame, run: str = "run_id") -> DataFrame:
    """Sum of the rounded stage times, as reported, which is not the time from first start to last end."""
    return stages.groupBy(run).agg(F.round(F.sum("seconds"), 2).alias("total_wall_sec"))


def peak_memory(snapshots: DataFrame, used: Column, run: str = "run_id") -> DataFrame:
    return snapshots.groupBy(run).agg(F.max(used).alias("peak"))


def run_report(stages: DataFrame, *facts: DataFrame, run: str = "run_id") -> DataFrame:
    """Stage rows of each run with its totals and the one-row-per-run ``facts``."""
    out = stages.join(wall_total(stages, run), run)
    for fact in facts:
        out = out.join(fact, run, "left")
    return out


def metrics_json(stages: DataFrame, names: tuple[str, ...], run: str = "run_id") -> DataFrame:
    """One JSON metrics document per run, with the stages as a map; the stage names are fixed."""
    seconds = [F.max(F.when(F.col("stage") == name, F.col("seconds"))).alias(name) for name in names]
    wide = stages.groupBy(run).agg(*seconds)
    pairs = [part for name in names for part in (F.lit(name), F.col(name))]
    taken = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    doc = F.to_json(F.struct(F.col(run).cast("string").alias("run_tag"), taken.alias("stages")))
    return wide.select(run, doc.alias("document"))


def stage_rows(documents: DataFrame) -> DataFrame:
    """Stages of metrics documents as rows."""
    return documents.select("run_tag", F.explode(F.map_entries("stages")).alias("e")).select(
        "run_tag", F.col("e.key").alias("stage"), F.col("e.value").alias("seconds")
    )


def leaderboard(documents: DataFrame, metric: str = "training_result.train_loss") -> DataFrame:
    """Runs of a sweep ranked by their final metric, lowest first, runs without one last."""
    rows = documents.select(
        "run_tag", "mode", "lora.r", "training_config.learning_rate", F.col(metric).alias("metric"), "peak_vram_gb"
    ).withColumn("_none", F.col("metric").isNull())
    return order_rows(rows, [], ["_none", "metric", "run_tag"]).scan(rank=number()).rows().drop("_none")


def sweep_settings(rows: DataFrame, mode: Column, rank: Column, rate: Column) -> DataFrame:
    """Adapter rank and learning rate of each run: its own or the default of its mode; other modes are marked."""
    name = F.lower(mode)
    default_rank, default_rate = F.lit(None).cast("int"), F.lit(None).cast("double")
    for known, (r, lr) in MODE_DEFAULTS.items():
        default_rank = F.when(name == known, r).otherwise(default_rank)
        default_rate = F.when(name == known, lr).otherwise(default_rate)
    known_mode = F.coalesce(name.isin(*MODE_DEFAULTS), F.lit(False))
    return rows.withColumns(
        {
            "mode": name,
            "known_mode": known_mode,
            "r": F.when(known_mode, F.coalesce(rank, default_rank)),
            "learning_rate": F.when(known_mode, F.coalesce(rate, default_rate)),
        }
    )


def compared(samples: DataFrame, phases: tuple[str, ...], prompt: str = "prompt_idx") -> DataFrame:
    """Responses to each prompt side by side, one column per phase, and whether the last differs from the first."""
    columns = [F.max(F.when(F.col("phase") == p, F.col("response"))).alias(p) for p in phases]
    out = samples.groupBy(prompt).agg(*columns)
    return out.withColumn("changed", ~F.col(phases[0]).eqNullSafe(F.col(phases[-1])))
