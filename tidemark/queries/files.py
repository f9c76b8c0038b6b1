"""Queries over files the library writes and reads: records, result files, metrics documents, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import chat as c
from tidemark.operators import experiments as x
from tidemark.operators import telemetry as o
from tidemark.plans.staging import stage, staged_path
from tidemark.queries.registry import query
from tidemark.queries.views import EXPERIMENTS, STAGES, STEP_LOG, with_views
from tidemark.sources import readers, sinks, tables

TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
          "orders", "pages", "part", "region", "supplier")

RECORDS = """WITH messages AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'model' END AS role, text FROM conversations
  WHERE role IN ('user', 'assistant') AND trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> ''),
made AS (SELECT conv_id, string_agg(left(role, 1), '' ORDER BY turn) AS letters,
  string_agg('<|turn>' || role || chr(10) || text || '<turn|>' || chr(10), '' ORDER BY turn) AS text FROM messages GROUP BY conv_id),
texts AS (SELECT c.conv_id, CASE WHEN regexp_matches(letters, '^(um)+u?$') THEN text END AS text
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN made m ON c.conv_id = m.conv_id)
"""


def written_records(spark, folder):
    """Whole conversations as records, written as JSON and read back.

    Even ids have the from/value schema, the others role/content, every other of these with a list of parts.
    """
    text, kind = F.col("text"), F.col("conv_id") % 4
    who = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    part = lambda name, value: F.struct(F.lit(name).alias("type"), value.alias("text"))
    parts = F.array(part("image", F.lit("left out")), part("text", text))
    turn = (
        F.when(kind % 2 == 0, F.to_json(F.struct(who.alias("from"), text.alias("value"))))
        .when(kind == 1, F.to_json(F.struct("role", text.alias("content"))))
        .otherwise(F.to_json(F.struct("role", parts.alias("content"))))
    )
    turns = tables.turns(spark, folder).select("conv_id", "turn", turn.alias("turn_json"))
    # A record is one value of its file, so its turns are gathered.
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "turn_json"))).alias("all"))
    joined = F.array_join(F.transform("all", lambda t: t["turn_json"]), ",")
    record = F.concat(F.lit('{"conv_id":'), "conv_id", F.lit(',"conversations":['), joined, F.lit("]}"))
    path = staged_path(spark, "records")
    sinks.write_lines(whole.select(record.alias("line")), path, "line")
    return readers.json_records(spark, path, f"conv_id bigint, {schemas.RECORD}")


@query("s7_json_records", """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place,
  CASE WHEN conv_id % 2 = 1 THEN role WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS who, text
FROM conversations""")
def s7(spark, folder):
    turns = written_records(spark, folder).select("conv_id", F.posexplode("conversations").alias("place", "t"))
    text = F.coalesce("t.value", c.variant_text(F.col("t.content")))
    return turns.select("conv_id", F.col("place").cast("bigint").alias("place"), F.coalesce("t.from", "t.role").alias("who"), text.alias("text"))


@query("f1_record_texts", RECORDS + "SELECT conv_id, text FROM texts")
def f1(spark, folder):
    messages = c.record_messages(F.col("conversations"), c.variant_text)
    return written_records(spark, folder).select("conv_id", c.record_text(messages).alias("text"))


@query("f2_kept_records", RECORDS + "SELECT count(*) AS raw_size, count(*) FILTER (text IS NOT NULL) AS size FROM texts")
def f2(spark, folder):
    rows = f1(spark, folder)
    return rows.agg(F.count(F.lit(1)).alias("raw_size"), F.count_if(F.col("text").isNotNull() & (F.length("text") > 0)).alias("size"))


@query("p23_record_problems", """
SELECT conv_id, CASE conv_id % 5 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'no conversations' WHEN 3 THEN 'no turns'
  WHEN 4 THEN 'turn without from or value' END AS problem FROM (SELECT DISTINCT conv_id FROM conversations)""")
def p23_records(spark, folder):
    """Raw lines of a user's file: whole records, cut ones, and records that lack what is needed."""
    turns = tables.from_value_turns(spark, folder)
    value = F.when((F.col("conv_id") % 5 != 4) | (F.col("turn") > 0), F.col("value"))
    turns = turns.select("conv_id", F.struct("turn", F.col("from"), value.alias("value")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("all"))
    kept = F.transform("all", lambda t: F.struct(t["from"].alias("from"), t["value"].alias("value")))
    line = F.to_json(F.struct("conv_id", kept.alias("conversations")))
    bare = F.to_json(F.struct("conv_id"))
    kind = F.col("conv_id") % 5
    line = (
        F.when(kind == 1, F.left(line, F.length(line) - 2))
        .when(kind == 2, bare)
        .when(kind == 3, F.concat(F.left(bare, F.length(bare) - 1), F.lit(',"conversations":[]}')))
        .otherwise(line)
    )
    path = staged_path(spark, "raw-records")
    sinks.write_lines(whole.select(line.alias("line")), path, "line")
    raw = spark.read.text(path)
    parsed = raw.select(
        F.regexp_extract("value", r'"conv_id":(\d+)', 1).cast("bigint").alias("conv_id"),
        c.line_problem(F.col("value")).alias("problem"),
    )
    return parsed


@query("s11_result_files", with_views(EXPERIMENTS) + """
SELECT commit, val_bpb, memory_gb, status, trim(description) AS description FROM experiments""")
def s11(spark, folder):
    raw = tables.raw_results(spark, folder)
    clean = raw.select("commit", "val_text", "mem_text", F.trim(F.translate("status_text", "\t", " ")).alias("status_text"),
                       F.trim("description").alias("description"))
    path = staged_path(spark, "results")
    sinks.write_result_files(clean, path)
    return x.coerce_results(readers.result_files(spark, path)).select(
        "commit", "val_bpb", "memory_gb", "status", "description"
    )


@query("s12_appended_results", with_views(EXPERIMENTS) + "SELECT tag, event_id, commit, val_bpb, status FROM experiments")
def s12(spark, folder):
    rows = x.coerce_results(tables.raw_results(spark, folder)).select("tag", "event_id", "commit", "val_bpb", "status")
    path = staged_path(spark, "appended")
    sinks.append_results(x.kept(rows), path)
    sinks.append_results(rows.filter(F.col("status") != x.KEEP), path)
    return spark.read.schema(rows.schema).parquet(path)


def documents(spark, folder):
    """Metrics documents of a sweep: settings, stages and final loss of each run."""
    stages = o.stage_durations(tables.stage_events(spark, folder))
    names = ("click", "error", "purchase", "signup", "view")
    seconds = [F.max(F.when(F.col("stage") == n, F.col("seconds"))).alias(n) for n in names]
    pairs = [part for n in names for part in (F.lit(n), F.col(n))]
    wide = stages.groupBy("run_id").agg(*seconds)
    log = tables.step_log(spark, folder).groupBy("run_id").agg(F.min("loss").alias("loss"), F.count(F.lit(1)).alias("steps"))
    mode = F.when(F.col("run_id") % 2 == 0, "generic").otherwise("domain")
    doc = F.struct(
        F.col("run_id").cast("string").alias("run_tag"),
        mode.alias("mode"),
        F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("stages"),
        F.struct(F.when(F.col("run_id") % 2 == 0, 8).otherwise(32).alias("r")).alias("lora"),
        F.struct(  # a run is limited by steps or by epochs, as its mode has it
            F.lit(2e-4).alias("learning_rate"),
            F.when(mode == "generic", F.col("steps")).alias("max_steps"),
            F.when(mode == "domain", F.lit(20)).alias("num_epochs"),
        ).alias("training_config"),
        F.when(F.col("run_id") % 11 != 0, F.struct(F.col("loss").alias("train_loss"))).alias("training_result"),
    )
    return wide.join(log, "run_id").select("run_id", F.to_json(doc).alias("document"))


def read_documents(spark, folder):
    path = staged_path(spark, "metrics")
    sinks.write_metrics(documents(spark, folder), path)
    return readers.metrics_lines(spark, path)


@query("s13_metrics_sink", with_views(STAGES, STEP_LOG) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, stage, seconds FROM stages WHERE seconds IS NOT NULL
AND run_id IN (SELECT run_id FROM step_log)""")
def s13(spark, folder):
    return o.stage_rows(read_documents(spark, folder))


@query("s14_metrics_documents", with_views(STEP_LOG) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, CASE WHEN run_id % 2 = 0 THEN 'generic' ELSE 'domain' END AS mode,
  CASE WHEN run_id % 11 <> 0 THEN min(loss) END AS train_loss, CAST(NULL AS DOUBLE) AS peak_vram_gb FROM step_log GROUP BY run_id""")
def s14(spark, folder):
    return read_documents(spark, folder).select("run_tag", "mode", "training_result.train_loss", "peak_vram_gb")


def sweep_folders(spark, folder):
    """The documents of a sweep, saved by run."""
    path = staged_path(spark, "sweep")
    sinks.replace_run_documents(documents(spark, folder).withColumnRenamed("run_id", "run"), path)
    value = readers.document_value
    return readers.run_documents(spark, path).select(
        value("$.run_tag", "string").alias("run_tag"),
        value("$.mode", "string").alias("mode"),
        value("$.stages", "map<string, double>").alias("stages"),
        F.struct(value("$.lora.r", "int").alias("r")).alias("lora"),
        F.struct(
            value("$.training_config.learning_rate", "double").alias("learning_rate"),
            value("$.training_config.max_steps", "bigint").alias("max_steps"),
            value("$.training_config.num_epochs", "bigint").alias("num_epochs"),
        ).alias("training_config"),
        F.struct(value("$.training_result.train_loss", "double").alias("train_loss")).alias("training_result"),
        value("$.peak_vram_gb", "double").alias("peak_vram_gb"),
    )


@query("s13_saved_by_run", with_views(STAGES, STEP_LOG) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, stage, seconds FROM stages WHERE seconds IS NOT NULL
AND run_id IN (SELECT run_id FROM step_log) AND (run_id % 3 <> 0 OR stage IN ('click', 'error'))""")
def s13_by_run(spark, folder):
    """Documents saved after two stages and at the end; every third run is killed in between and keeps what it had."""
    path = staged_path(spark, "saved")
    rows = stage(documents(spark, folder).withColumnRenamed("run_id", "run"), "documents")
    early = F.map_filter(F.from_json(F.get_json_object("document", "$.stages"), "map<string, double>"), lambda k, _: k.isin("click", "error"))
    begun = F.to_json(F.struct(F.col("run").cast("string").alias("run_tag"), early.alias("stages")))
    sinks.replace_run_documents(rows.withColumn("document", begun), path)
    for _ in range(2):  # the last save is retried
        sinks.replace_run_documents(rows.filter("run % 3 <> 0"), path)
    return o.stage_rows(readers.run_documents(spark, path).select(
        readers.document_value("$.run_tag", "string").alias("run_tag"),
        readers.document_value("$.stages", "map<string, double>").alias("stages"),
    ))


@query("s14_run_folders", with_views(STEP_LOG) + """
SELECT CAST(run_id AS VARCHAR) AS run_tag, CASE WHEN run_id % 2 = 0 THEN 'generic' ELSE 'domain' END AS mode,
  CASE WHEN run_id % 11 <> 0 THEN min(loss) END AS train_loss, CASE WHEN run_id % 2 = 0 THEN 8 ELSE 32 END AS r,
  CASE WHEN run_id % 2 = 0 THEN count(*) END AS max_steps, CASE WHEN run_id % 2 = 1 THEN 20::BIGINT END AS num_epochs
FROM step_log GROUP BY run_id""")
def s14_folders(spark, folder):
    return sweep_folders(spark, folder).select(
        "run_tag", "mode", "training_result.train_loss", "lora.r", "training_config.max_steps", "training_config.num_epochs"
    )


@query("a17_leaderboard", with_views(STEP_LOG) + """
, runs AS (SELECT CAST(run_id AS VARCHAR) AS run_tag, CASE WHEN run_id % 2 = 0 THEN 'generic' ELSE 'domain' END AS mode,
  CASE WHEN run_id % 11 <> 0 THEN min(loss) END AS metric FROM step_log GROUP BY run_id)
SELECT run_tag, mode, metric, row_number() OVER (ORDER BY metric NULLS LAST, run_tag) AS rank FROM runs""")
def a17(spark, folder):
    return o.leaderboard(sweep_folders(spark, folder)).select("run_tag", "mode", "metric", "rank")


@query("s18_folder_size", f"SELECT CAST({len(TABLES)} AS BIGINT) AS n_files, true AS holds_bytes")
def s18(spark, folder):
    return readers.folder_size(spark, folder).select("n_files", (F.col("total_mb") > 0).alias("holds_bytes"))


@query("s18_folder_mb")
def s18_size(spark, folder):
    """The size in MiB and the number of files; the tests compare it with the file system."""
    return readers.folder_size(spark, folder)


@query("f3_checked_shards", " UNION ALL ".join(
    f"SELECT '{name}.parquet' AS file_name, count(*) AS n_rows FROM {name}" for name in TABLES
))
def f3(spark, folder):
    return readers.checked_shards(spark, folder)


@query("s8_first_existing", "SELECT 'documents.parquet' AS file_name, count(*) AS n_docs FROM documents")
def s8(spark, folder):
    path = readers.first_existing(spark, [f"{folder}/none/documents.parquet", f"{folder}/documents.parquet"])
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_docs"))
    return rows.select(F.lit(path.rsplit("/", 1)[-1]).alias("file_name"), "n_docs")


# How a table from rows the driver holds names the languages.
LANGUAGES = (("en", "English"), ("fr", "French"), ("de", "German"), ("es", "Spanish"))


@query("s10_rows_to_table", """
SELECT name, count(*) AS n_docs FROM documents JOIN (VALUES ('en', 'English'), ('fr', 'French'), ('de', 'German'), ('es', 'Spanish'))
  l(lang, name) USING (lang) GROUP BY name""")
def s10(spark, folder):
    names = readers.table_of(spark, LANGUAGES, "lang string, name string")
    counts = tables.corpus(spark, folder).groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.join(names, "lang").select("name", "n_docs")
