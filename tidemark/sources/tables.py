"""Views of stored tables as the inputs of the operators: documents, conversations, results, logs, job states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.ordered import following, number, order_rows
from tidemark.sources.readers import spread


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their shard number; order inside the corpus is (shard, doc_id)."""
    return read(spark, folder, "documents").select(
        F.expr("cast(substring(source, 4) as int)").alias("shard"), "doc_id", "text", "lang", "source"
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus for work that costs much per text."""
    return spread(corpus(spark, folder))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns, one row each: conv_id, turn, role, text."""
    return read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")


def from_value_turns(spark: SparkSession, folder: str) -> DataFrame:
    """The same turns in the from/value schema."""
    who = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    return turns(spark, folder).select("conv_id", "turn", who.alias("from"), F.col("text").alias("value"))


def raw_results(spark: SparkSession, folder: str) -> DataFrame:
    """Experiment results as text columns, one research tag per user of the event table."""
    kind = F.col("event_type")
    k = F.regexp_extract("props", r"(\d+)", 1)
    value = F.col("value").cast("string")
    return read(spark, folder, "events").select(
        F.col("user_id").alias("tag"),
        "ts",
        "event_id",
        F.substring(F.md5(F.col("event_id").cast("string")), 1, 7).alias("commit"),
        F.when(kind == "error", "0.000000").when(F.col("props").endswith("7}"), "n/a").otherwise(value).alias("val_text"),
        F.when(kind == "error", "0.0").otherwise(k).alias("mem_text"),
        F.when(kind == "purchase", " keep")
        .when(kind == "signup", "KEEP\t")
        .when(kind == "view", "Discard ")
        .when(kind == "click", "discard")
        .otherwise("crash")
        .alias("status_text"),
        F.concat(F.lit("  "), kind, F.lit(" at setting "), F.col("props"), F.lit(" gives "), value, F.lit(" ")).alias(
            "description"
        ),
    )


def step_log(spark: SparkSession, folder: str) -> DataFrame:
    """Step telemetry, one run per user: step, loss, and the microseconds until the next step (last step dropped)."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    events = read(spark, folder, "events").select(
        F.col("user_id").alias("run_id"), "event_id", at.alias("at_us"), F.col("value").alias("loss")
    )
    return (
        order_rows(events, ["run_id"], ["at_us", "event_id"])
        .scan(step=number(0), next_us=following("at_us"))
        .rows()
        .filter("next_us is not null")
        .select("run_id", "step", "loss", F.expr("next_us - at_us").alias("dt_us"))
    )


def job_states(spark: SparkSession, folder: str) -> DataFrame:
    """Observed states of jobs, one job per user: slug, ts, event_id, state ('' when the lookup failed)."""
    kind = F.col("event_type")
    state = (
        F.when(F.col("props").endswith("3}"), "")
        .when(kind == "signup", "queued")
        .when(kind.isin("view", "click"), "running")
        .when(kind == "purchase", "succeeded")
        .otherwise("failed")
    )
    return read(spark, folder, "events").select(
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("slug"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"),
        "event_id",
        state.alias("state"),
    )


def json_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns in the role/content schema, content as JSON: a string, a list of parts, or null."""
    text, role = F.col("text"), F.col("role")
    quoted = F.to_json(F.struct(text.alias("c")))
    parts = F.to_json(
        F.array(
            F.struct(F.lit("text").alias("type"), text.alias("text")),
            F.struct(F.lit("image").alias("type"), F.lit("picture").alias("text")),
            F.struct(F.lit("text").alias("type"), role.alias("text")),
            F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("text")),
        )
    )
    content = (
        F.when(F.expr("conv_id % 5 = 0 and turn = 2"), "null")
        .when(F.expr("turn % 3 = 0"), parts)
        .otherwise(F.expr("substring(quoted, 6, length(quoted) - 6)"))
    )
    return turns(spark, folder).withColumn("quoted", quoted).select("conv_id", "turn", "role", content.alias("content"))


def uneven_turns(spark: SparkSession, folder: str) -> DataFrame:
    """from/value turns with blank texts, dropped roles and turns that have no role at all."""
    who = F.when(F.expr("conv_id % 7 = 3 and turn = 1"), None).when(
        F.expr("conv_id % 4 = 1 and turn = 1"), "system"
    ).otherwise(F.col("from"))
    value = F.when(F.expr("conv_id % 3 = 1 and turn % 4 = 3"), " \n\t\u00a0 ").otherwise(F.col("value"))
    return from_value_turns(spark, folder).select("conv_id", "turn", who.alias("from"), value.alias("value"))


def run_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the captured log of each run: start-up lines, the summary block, a closing line."""
    step = F.col("step")
    runs = step_log(spark, folder).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.min("loss").alias("best"),
        F.coalesce(F.sum(F.when(step > 10, F.col("dt_us"))), F.lit(0)).alias("timed_us"),
        F.sum("dt_us").alias("all_us"),
    )

    def tenths(us: str):
        whole = F.expr(f"{us} div 1000000"), F.expr(f"({us} div 100000) % 10")
        return F.format_string("%d.%d", *whole)

    def line(key: str, value):
        return F.concat(F.rpad(F.lit(key + ":"), 18, " "), value)

    lines = F.array(
        F.concat(F.lit("starting run "), F.col("run_id").cast("string")),
        F.lit("val_bpb is computed at the end"),
        F.lit("---"),
        line("val_bpb", F.format_string("%.6f", "best")),
        line("training_seconds", tenths("timed_us")),
        line("total_seconds", tenths("all_us")),
        line("peak_vram_mb", F.format_string("%d.5", F.col("steps") * 100)),
        line("num_steps", F.col("steps").cast("string")),
        line("depth", F.lit("8")),
        F.lit("finished"),
    )
    slug = F.concat(F.lit("job-"), F.col("run_id").cast("string")).alias("slug")
    return runs.select("run_id", slug, F.posexplode(lines).alias("line_no", "line"))


def raw_step_lines(spark: SparkSession, folder: str, updates: int = 8) -> DataFrame:
    """Raw log lines that each hold up to ``updates`` step updates separated by returns."""
    update = F.format_string(
        "step %05d (%d.0%%) | loss: %.6f | lrm: 0.%d0 | dt: %dms | tok/sec: %s | mfu: %d.5%% | epoch: %d | remaining: %ds    ",
        F.col("step"),
        F.expr("step div 2"),
        F.col("loss"),
        F.expr("step % 10"),
        F.expr("dt_us div 1000"),
        F.format_number(F.expr("524288000000 div dt_us"), 0),
        F.expr("step % 50"),
        F.expr("1 + step div 50"),
        F.expr("greatest(0, 300 - step)"),
    )
    steps = step_log(spark, folder).filter("dt_us > 0").withColumn("update", update)
    held = F.array_sort(F.collect_list(F.struct("step", "update")))
    lines = steps.groupBy("run_id", F.expr(f"step div {updates}").alias("line_no")).agg(held.alias("u"))
    return lines.select(
        "run_id", "line_no", F.array_join(F.transform("u", lambda x: F.concat(F.lit("\r"), x["update"])), "").alias("line")
    )


def stage_events(spark: SparkSession, folder: str) -> DataFrame:
    """Start and end marks of the stages of each run."""
    odd = F.regexp_extract("props", r"(\d+)", 1).cast("int") % 2 == 1
    return read(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at_us"),
        F.when(odd, "start").otherwise("end").alias("edge"),
    )


def gpu_lines(spark: SparkSession, folder: str) -> DataFrame:
    """GPU snapshot lines of each run; some are error messages."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    line = F.when(F.col("event_type") == "error", "snapshot failed").otherwise(
        F.concat(F.lit("Accelerator A, "), (k.cast("int") * 100).cast("string"), F.lit(", 81920, "), k, F.lit(", 41"))
    )
    return read(spark, folder, "events").select("event_id", F.col("user_id").alias("run_id"), line.alias("line"))


def job_list(spark: SparkSession, folder: str) -> DataFrame:
    """Job records: position in the listing, slug and name. Names repeat."""
    k = F.regexp_extract("props", r"(\d+)", 1)
    return read(spark, folder, "events").select(
        F.col("event_id").alias("idx"),
        F.concat(F.lit("job-"), F.col("event_id").cast("string")).alias("slug"),
        F.concat_ws("-", "event_type", k).alias("name"),
    )
