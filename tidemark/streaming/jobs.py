"""Streaming forms of job states, run telemetry, decisions and metrics documents, on the engine's own keyed state.

Each takes a stream and returns one. A key's state is a few values, stored with those of other keys of its hash in the engine's
state store; event-time time-outs end waits, report silent jobs and remove what is no longer needed. Rows of a key must arrive in order across
micro-batches, within the stated watermark; inside a micro-batch they are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions import schedules as s
from tidemark.operators import experiments as x
from tidemark.operators import jobs as j
from tidemark.sources import sinks

#: How far behind the latest observation rows may arrive.
DELAY = "10 seconds"
#: How long an ended key is remembered, so that late rows of it are not taken for a new one.
KEEP_ENDED_S = 30 * 24 * 3600
#: In place of a time-out: the key has ended. An open key without a time-out stays, however long it is silent.
ENDED = -1

#: Keys are called, and their states stored, together by a hash in this many groups: a call costs milliseconds, a key in it
#: microseconds. A checkpoint keeps to the number that it began with.
GROUPS = 1_024
#: The group of rows without a key.
NO_KEY = -1

Rows = list[tuple]


def _keyed(
    stream: DataFrame,
    key: str,
    order: list[str],
    step: Callable[[tuple | None, Rows], tuple[tuple | None, Rows, int | None]],
    expire: Callable[[tuple], tuple[tuple | None, Rows]],
    output: str,
    state: str,
    at: str,
    groups: int = GROUPS,
) -> DataFrame:
    """``step`` turns the state and the sorted new rows of a key into new state, output rows and a time-out in ms.

    The time-out is None for an open key that waits for ever and ``ENDED`` for one that is done. ``expire`` is asked when
    the time is up; state None removes the key, another one has ended. Each of ``groups`` holds the keys of one hash, their
    states and time-outs; it is called when rows of one of them arrive or the first of their time-outs is over.
    """
    names = [f.split()[0] for f in output.split(", ")]
    columns = [c for c in stream.columns if c not in (key, at)]

    def run(group: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        keys = {k: (until, before) for k, until, before in held.get[0]} if held.exists else {}
        watermark = held.getCurrentWatermarkMs()
        seen, out = set(), []

        def put(own, after: tuple | None, made: Rows, limit: int | None, now: int) -> None:
            out.extend((own, *row) for row in made)
            if after is None:
                keys.pop(own, None)
            else:
                until = now + KEEP_ENDED_S * 1000 if limit == ENDED else limit
                keys[own] = (until if until is None else max(until, watermark + 1), after)

        if not held.hasTimedOut:
            rows = pd.concat(list(frames)).sort_values([key, *order])
            own = [None] * len(rows) if group[0] == NO_KEY else rows[key].tolist()
            times = rows[at].to_numpy().astype("datetime64[ms]").astype("int64").tolist()
            for k, part in groupby(zip(own, times, rows[columns].itertuples(index=False, name=None)), key=lambda r: r[0]):
                part = list(part)
                seen.add(k)
                now = max(watermark, *(r[1] for r in part))  # the watermark of a first batch is zero
                put(k, *step(keys[k][1] if k in keys else None, [r[2] for r in part]), now)
        for k in [k for k, (until, _) in keys.items() if until is not None and until < watermark and k not in seen]:
            put(k, *expire(keys[k][1]), ENDED, watermark)
        if keys:
            held.update(([(k, *entry) for k, entry in keys.items()],))
            if ends := [until for until, _ in keys.values() if until is not None]:
                held.setTimeoutTimestamp(max(min(ends), watermark + 1))
        elif held.exists:
            held.remove()
        if out:
            yield pd.DataFrame(out, columns=names)

    kind = stream.schema[key].dataType.simpleString()
    place = F.when(F.col(key).isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64(key), F.lit(groups)))
    timed = stream.withWatermark(at, DELAY).withColumn("_group", place.cast("int"))
    entries = f"entries array<struct<key: {kind}, until: bigint, state: struct<{state}>>>"
    return timed.groupBy("_group").applyInPandasWithState(run, output, entries, "append", GroupStateTimeout.EventTimeTimeout)


def _at(column: str):
    return F.timestamp_micros(column).alias("at")


def state_changes(stream: DataFrame) -> DataFrame:
    """Changes of job states until a job ends; observations (slug, at_us, event_id, state)."""

    def step(before, rows):
        last, ended = before or ("", False)
        out = []
        for _, event_id, state in rows:
            if ended:
                break
            if state and state != last:
                out.append((event_id, state))
                last = state
            ended = state in j.TERMINAL_STATES
        return (last, ended), out, ENDED if ended else None

    rows = stream.select("slug", "at_us", "event_id", "state", _at("at_us"))
    return _keyed(
        rows, "slug", ["at_us", "event_id"], step, lambda before: (None, []),
        "slug string, event_id bigint, state string", "last string, ended boolean", "at",
    )


def waited_states(stream: DataFrame, timeout_s: int = j.TIMEOUT_S) -> DataFrame:
    """Waiting for jobs: a row when a job ends in time, and one when its time is up, also of a job that went silent.

    Time is that of the observations; a job's clock starts with its first one. Rows: slug, state, timed_out. A job
    that has been told is remembered for a while, so that its later observations start no new wait.
    """
    limit = timeout_s * 1_000_000

    def shown(last):
        return last or j.UNKNOWN

    def step(before, rows):
        start, last, told = before or (rows[0][0], "", False)
        out = []
        for at_us, _, state in rows:
            if told:
                break
            if at_us > start + limit:
                out, told = [(shown(last), True)], True
            elif state in j.TERMINAL_STATES:
                out, told = [(state, False)], True
            else:
                last = state
        return (start, last, told), out, ENDED if told else (start + limit) // 1000 + 1

    def expire(before):
        start, last, told = before
        return (None, []) if told else ((start, last, True), [(shown(last), True)])

    rows = stream.select("slug", "at_us", "event_id", "state", _at("at_us"))
    return _keyed(
        rows, "slug", ["at_us", "event_id"], step, expire,
        "slug string, state string, timed_out boolean", "start bigint, last string, told boolean", "at",
    )


def run_progress(stream: DataFrame) -> DataFrame:
    """Smoothed loss, training time and divergence of each step as it arrives; steps (run_id, step, loss, dt_us, at).

    Steps after divergence are left out.
    """
    beta = s.EMA_BETA

    def step(before, rows):
        mean, seen, trained, failed = before or (0.0, 0, 0, False)
        out = []
        for number, loss, dt_us in rows:
            if failed:
                break
            mean, seen = beta * mean + (1 - beta) * loss, seen + 1
            trained += int(dt_us) if number > s.UNTIMED_STEPS else 0
            failed = bool(math.isnan(loss) or loss > s.DIVERGED_LOSS)
            out.append((int(number), mean / (1 - beta**seen), trained, failed))
        return (mean, seen, trained, failed), out, ENDED if failed else None

    rows = stream.select("run_id", "step", "loss", "dt_us", "at")
    return _keyed(
        rows, "run_id", ["step"], step, lambda before: (None, []),
        "run_id bigint, step bigint, smooth_loss double, trained bigint, failed boolean",
        "mean double, seen bigint, trained bigint, failed boolean", "at",
    )


def decisions(stream: DataFrame) -> DataFrame:
    """Accept/reject of experiments as they arrive; rows (tag, ts, event_id, val_bpb, status)."""

    def step(before, rows):
        best = before[0] if before else None
        out = []
        for _, event_id, value, status in rows:
            value = None if value is None or math.isnan(value) else value
            if status == x.CRASH:
                out.append((event_id, x.CRASH))
                continue
            better = value is not None and (best is None or value < best)
            out.append((event_id, x.KEEP if better else "DISCARD"))
            best = value if better else best
        return (best,), out, None

    rows = stream.select("tag", F.unix_micros("ts").alias("order_us"), "event_id", "val_bpb", "status", F.col("ts").alias("at"))
    return _keyed(
        rows, "tag", ["order_us", "event_id"], step, lambda before: (None, []),
        "tag bigint, event_id bigint, decision string", "best double", "at",
    )


def metrics_progress(stream: DataFrame) -> DataFrame:
    """Stage times of each run as far as they are known; marks (run_id, stage, at_us, edge). For update mode."""
    began = F.min(F.when(F.col("edge") == "start", F.col("at_us")))
    ended = F.max(F.when(F.col("edge") == "end", F.col("at_us")))
    seconds = F.round((ended - began) / F.lit(1e6), 2)
    return stream.groupBy("run_id", "stage").agg(seconds.alias("seconds"))


def run_documents(stream: DataFrame, stages: Sequence[str]) -> DataFrame:
    """The metrics document of each run as far as its ``stages`` are known; marks (run_id, stage, at_us, edge). For update mode."""

    def seconds(stage: str) -> Column:
        mark = lambda edge: F.when((F.col("stage") == stage) & (F.col("edge") == edge), F.col("at_us"))
        return F.round((F.max(mark("end")) - F.min(mark("start"))) / F.lit(1e6), 2).alias(stage)

    rows = stream.groupBy("run_id").agg(*[seconds(stage) for stage in stages])
    known = F.map_filter(F.create_map(*[part for s in stages for part in (F.lit(s), F.col(s))]), lambda _, v: v.isNotNull())
    tag = F.col("run_id").cast("string")
    return rows.select(tag.alias("run"), F.to_json(F.struct(tag.alias("run_tag"), known.alias("stages"))).alias("document"))


def write_run_documents(documents: DataFrame, path: str, progress: str) -> None:
    """Replace the documents of the runs that a micro-batch has changed; a batch that is repeated writes the same again."""
    writer = documents.writeStream.foreachBatch(lambda batch, _: sinks.replace_run_documents(batch, path))
    writer.outputMode("update").option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()


def write_stream(stream: DataFrame, path: str, progress: str) -> None:
    """Process what the source has now into a table, continuing after earlier runs."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()


def write_updates(stream: DataFrame, path: str, progress: str) -> None:
    """The same for update mode: each micro-batch's changed rows with its number as ``version``."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={number}")

    writer = stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()


def latest_rows(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key's row."""
    rest = [c for c in updates.columns if c not in (*keys, "version")]
    newest = F.max_by(F.struct(*rest), "version").alias("_newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
