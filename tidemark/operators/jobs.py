"""Job records: states over time, log tails, roll-ups, matching by name, cost and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.telemetry import is_report_line
from tidemark.plans.ordered import latest, order_rows, previous

# States that end a job, the state shown for an empty answer, lines shown, and the waiting time.
SUCCEEDED = "succeeded"
FAILED_STATES = ("failed", "terminated", "cancelled")
TERMINAL_STATES = (SUCCEEDED,) + FAILED_STATES
UNKNOWN = "?"
REPORT_TAIL, FAILED_TAIL, LOG_LIMIT = 20, 25, 1000
TIMEOUT_S = 1800

ORDER = ("at_us", "event_id")


def first_named(jobs: DataFrame, name: str, order: str = "idx") -> DataFrame:
    """Slug of the first job with this name, empty when there is none."""
    found = jobs.filter(F.col("name") == name).agg(F.min_by("slug", order).alias("slug"))
    return found.select(F.coalesce("slug", F.lit("")).alias("slug"))


def state_changes(states: DataFrame, show_unknown: bool = False) -> DataFrame:
    """Observations at which the state of a job differs from the one before.

    Empty answers are skipped, or with ``show_unknown`` count as a state of their own.
    """
    if show_unknown:
        rows = states.withColumn("state", F.when(F.col("state") == "", UNKNOWN).otherwise(F.col("state")))
        rows = order_rows(rows, ["slug"], ORDER).scan(before=previous("state")).rows()
    else:
        seen = F.when(F.col("state") != "", F.col("state"))
        rows = order_rows(states, ["slug"], ORDER).scan(before=latest(seen, inclusive=False)).rows()
        rows = rows.filter("state <> ''")
    return rows.filter(~F.col("state").eqNullSafe(F.col("before"))).drop("before")


def until_terminal(states: DataFrame) -> DataFrame:
    """Observations of each job up to and including its first terminal one."""
    ended = F.when(F.col("state").isin(*TERMINAL_STATES), F.lit(True))
    rows = order_rows(states, ["slug"], ORDER).scan(ended=latest(ended, inclusive=False)).rows()
    return rows.filter("ended is null").drop("ended")


def latest_states(states: DataFrame) -> DataFrame:
    """Last observed state of each job, unknown for an empty answer."""
    last = states.groupBy("slug").agg(F.max_by("state", F.struct(*ORDER)).alias("state"))
    return last.withColumn("state", F.when(F.col("state") == "", UNKNOWN).otherwise(F.col("state")))


def waited_states(states: DataFrame, timeout_s: int = TIMEOUT_S) -> DataFrame:
    """State of each job when waiting ends: at its first terminal state or when the time is up.

    The clock starts with a job's first observation. Observations are reduced to one row per job inside each
    input partition, so a job with very many of them costs nothing extra.
    """
    start = states.groupBy("slug").agg(F.min("at_us").alias("start_us"))
    rows = states.join(start, "slug").filter(F.col("at_us") <= F.col("start_us") + timeout_s * 1_000_000)
    at = F.struct(*ORDER)
    ends = F.col("state").isin(*TERMINAL_STATES)
    out = rows.groupBy("slug").agg(
        F.min_by("state", F.when(ends, at)).alias("_end"), F.max_by("state", at).alias("_last")
    )
    last = F.when(F.col("_last") == "", UNKNOWN).otherwise(F.col("_last"))
    return out.select("slug", F.coalesce("_end", last).alias("state"), F.col("_end").isNull().alias("timed_out"))


def log_tail(lines: DataFrame, n: int, slug: str = "slug", order: str = "line_no") -> DataFrame:
    """Last ``n`` lines of each job. Spark keeps only ``n`` rows per job before the shuffle."""
    if n > LOG_LIMIT:
        raise ValueError(f"at most {LOG_LIMIT} lines")
    back = Window.partitionBy(slug).orderBy(F.desc(order))
    return lines.withColumn("_n", F.row_number().over(back)).filter(F.col("_n") <= n).drop("_n")


def job_report(states: DataFrame, lines: DataFrame) -> DataFrame:
    """Per job: the summary lines of one that succeeded, the raw tail of any other."""
    last = latest_states(states)
    good = last.filter(F.col("state") == SUCCEEDED)
    other = last.filter(F.col("state") != SUCCEEDED)
    report = log_tail(lines.filter(is_report_line(F.col("line"))), REPORT_TAIL).join(good, "slug")
    return report.unionByName(log_tail(lines, FAILED_TAIL).join(other, "slug"))


def failed_jobs(latest_state: DataFrame) -> DataFrame:
    """Jobs that did not succeed, each with the number of them; no row means all is well."""
    failed = latest_state.filter(F.col("state") != SUCCEEDED)
    n = failed.agg(F.count(F.lit(1))).scalar()
    return failed.withColumn("n_failed", n)


def rollup(latest_state: DataFrame) -> DataFrame:
    ok = F.col("state") == SUCCEEDED
    return latest_state.agg(
        F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_ok"),
        F.count_if(~ok).alias("n_failed"),
        F.count_if(~F.col("state").isin(*TERMINAL_STATES)).alias("n_pending"),
    )


def cost(seconds: Column, usd_per_hour: Column) -> Column:
    return seconds / F.lit(3600.0) * usd_per_hour


def priced(runs: DataFrame, prices: DataFrame, max_prices: int = 10_000) -> DataFrame:
    """Runs with their price. The price list is broadcast once its size is known to be small."""
    few = prices.limit(max_prices + 1).count() <= max_prices
    rows = runs.join(F.broadcast(prices) if few else prices, "gpu")
    return rows.withColumn("cost_usd", cost(F.col("duration_s"), F.col("usd_per_hr")))


def throughput(walls: DataFrame, seconds: str = "wall_s") -> DataFrame:
    """Experiments per hour at the mean wall time."""
    return walls.agg(F.count(F.lit(1)).alias("runs"), F.try_divide(F.lit(3600.0), F.avg(seconds)).alias("per_hour"))


def phase_shares(phases: DataFrame, phase: str = "phase", seconds: str = "seconds") -> DataFrame:
    """Time of each phase and its share of all time."""
    sums = phases.groupBy(phase).agg(F.sum(seconds).alias("seconds"))
    total = phases.agg(F.sum(seconds)).scalar()
    return sums.withColumn("share", F.try_divide(F.col("seconds"), total))
