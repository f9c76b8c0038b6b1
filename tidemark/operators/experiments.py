"""Experiment analytics: coercion, outcomes, baselines, running best, ranking and accept/reject decisions.

Tables hold one row per experiment: ``tag`` (the research line), an order key unique inside the tag, ``val_bpb``,
``status`` and free columns. Lower values are better. Crashed experiments store 0 and never reach a minimum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.plans.ordered import Ordered, latest, number, order_key, order_rows, previous, running_min

# Outcomes, how far above the baseline the plot still shows, and its margin.
KEEP, DISCARD, CRASH = "KEEP", "DISCARD", "CRASH"
PLOT_SLACK = 0.0005
PLOT_MARGIN = 0.15

ORDER = ("ts", "event_id")


def coerce_results(raw: DataFrame) -> DataFrame:
    """Text columns of a results file to numbers and normalised outcomes."""
    return raw.select(
        *[c for c in raw.columns if c not in ("val_text", "mem_text", "status_text")],
        t.number_or_null(F.col("val_text")).alias("val_bpb"),
        t.number_or_null(F.col("mem_text")).alias("memory_gb"),
        t.status(F.col("status_text")).alias("status"),
    )


def kept(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == KEEP)


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") != CRASH)


def indexed(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER, name: str = "idx") -> DataFrame:
    """Number the experiments of each tag from 0."""
    return order_rows(df, by, order).scan(**{name: number(0)}).rows()


def outcome_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n"))


def keep_rate(df: DataFrame, by: Sequence[str] = ("tag",)) -> DataFrame:
    """Kept share of the decided experiments; crashes do not count, tags without a decision have no row."""
    counts = df.groupBy(*by).agg(
        F.count_if(F.col("status") == KEEP).alias("n_keep"), F.count_if(F.col("status") == DISCARD).alias("n_discard")
    )
    decided = F.col("n_keep") + F.col("n_discard")
    return counts.filter(decided > 0).withColumn("keep_rate", F.col("n_keep") / decided)


def _first(value: Column, order: Sequence[str], where: Column | None = None) -> Column:
    """Value on the first row, null if that value is null."""
    at = order_key(order)
    return F.min_by(value, at if where is None else F.when(where, at))


def baselines(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Both baselines of each tag: the first experiment at all, and the first that did not crash."""
    return df.groupBy(*by).agg(
        _first(F.col("val_bpb"), order).alias("baseline_first"),
        _first(F.col("val_bpb"), order, F.col("status") != CRASH).alias("baseline_valid"),
    )


def best_rows(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """The kept experiment with the lowest value in each tag, the first one on ties."""
    rest = [c for c in df.columns if c not in by]
    rows = kept(df).filter(F.col("val_bpb").isNotNull())
    best = F.min_by(F.struct(*rest), F.struct("val_bpb", *order)).alias("best")
    return rows.groupBy(*by).agg(best).select(*by, "best.*")


def improvement(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Baseline, best kept value, and their difference in absolute and relative terms."""
    best = F.min(F.when(F.col("status") == KEEP, F.col("val_bpb")))
    out = df.groupBy(*by).agg(_first(F.col("val_bpb"), order).alias("baseline"), best.alias("best"))
    gain = F.col("baseline") - F.col("best")
    return out.withColumn("gain", gain).withColumn("gain_pct", F.try_divide(gain, F.col("baseline")) * 100)


def plot_range(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    best = F.min(F.when(F.col("status") == KEEP, F.col("val_bpb")))
    base = _first(F.col("val_bpb"), order, F.col("status") != CRASH)
    out = df.groupBy(*by).agg(base.alias("base"), best.alias("best"))
    margin = (F.col("base") - F.col("best")) * PLOT_MARGIN
    return out.select(*by, (F.col("best") - margin).alias("low"), (F.col("base") + margin).alias("high"))


def near_baseline(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Experiments that did not crash and lie at or below their baseline plus the slack.

    The baselines are one row per tag. Spark broadcasts them when they are small at run time and otherwise
    splits a skewed tag in the shuffle.
    """
    base = baselines(df, by, order).select(*by, "baseline_valid")
    return valid(df).join(base, list(by)).filter(F.col("val_bpb") <= F.col("baseline_valid") + PLOT_SLACK)


def running_best(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Best kept value so far on every kept experiment; a missing value has none itself."""
    rows = order_rows(kept(df), by, order).scan(best_so_far=running_min("val_bpb")).rows()
    return rows.withColumn("best_so_far", F.when(F.col("val_bpb").isNotNull(), F.col("best_so_far")))


def deltas(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Improvement of each kept experiment over the kept one before; the first of a tag has none and is left out."""
    return _with_delta(_kept_in_order(df, by, order).rows())


def ranked_deltas(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Deltas ranked inside each tag, largest first, missing last, ties by order."""
    keyed = _with_delta(_kept_in_order(df, by, order).settled())
    keyed = keyed.withColumns({"_none": F.col("delta").isNull(), "_less": -F.col("delta")})
    return order_rows(keyed, by, ["_none", "_less", *order]).scan(rank=number()).rows().drop("_none", "_less")


def _kept_in_order(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> Ordered:
    return order_rows(kept(df), by, order).scan(kept_no=number(), prev_bpb=previous("val_bpb"))


def _with_delta(rows: DataFrame) -> DataFrame:
    return rows.filter("kept_no > 1").withColumn("delta", F.col("prev_bpb") - F.col("val_bpb"))


def effort(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Number of every kept experiment and how many experiments it took since the kept one before."""
    numbered = order_rows(df, by, order).scan(idx=number(0))
    kept_idx = F.when(F.col("status") == KEEP, F.col("idx"))
    out = kept(numbered.scan(prev_idx=latest(kept_idx, inclusive=False)).rows())
    return out.withColumn("took", F.col("idx") - F.col("prev_idx"))


def accept_reject(df: DataFrame, by: Sequence[str] = ("tag",), order: Sequence[str] = ORDER) -> DataFrame:
    """Decision on each experiment run one after another: keep it only when it beats every valid one before.

    A kept value is always a new minimum, so the best kept value equals the least valid value so far.
    """
    usable = F.when((F.col("status") != CRASH) & F.col("val_bpb").isNotNull(), F.col("val_bpb"))
    rows = order_rows(df.withColumn("_usable", usable), by, order)
    rows = rows.scan(idx=number(0), best_before=running_min("_usable", inclusive=False)).rows()
    beats = F.col("_usable").isNotNull() & (F.col("best_before").isNull() | (F.col("_usable") < F.col("best_before")))
    decision = F.when(F.col("status") == CRASH, CRASH).when(beats, KEEP).otherwise(DISCARD)
    return rows.withColumn("decision", decision).drop("_usable")


def round_winners(
    df: DataFrame, by: Sequence[str] = ("tag",), round_no: str = "round", candidate: str = "candidate"
) -> DataFrame:
    """Decision on each candidate of parallel rounds: the lowest of a round wins when it beats the best before it."""
    usable = F.when((F.col("status") != CRASH) & F.col("val_bpb").isNotNull(), F.col("val_bpb"))
    rows = df.withColumn("_usable", usable)
    at = F.when(F.col("_usable").isNotNull(), F.struct("_usable", candidate))
    rounds = rows.groupBy(*by, round_no).agg(F.min(at).alias("_top"))
    rounds = order_rows(rounds, by, [round_no]).scan(base=running_min("_top._usable", inclusive=False)).rows()
    joined = rows.join(rounds, [*by, round_no])
    wins = (F.col(candidate) == F.col("_top").getField(candidate)) & (
        F.col("base").isNull() | (F.col("_usable") < F.col("base"))
    )
    decision = F.when(F.col("status") == CRASH, CRASH).when(wins, KEEP).otherwise(DISCARD)
    return joined.withColumn("decision", decision).drop("_usable", "_top")
