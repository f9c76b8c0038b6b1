"""File readers and writers, and streams of several micro-batches beside their batch forms."""

import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import corpus as p
from tidemark.operators import experiments as x
from tidemark.operators import jobs as j
from tidemark.operators import telemetry as o
from tidemark.plans.staging import stage, staged_path
from tidemark.queries import all_queries
from tidemark.session import shared_dir
from tidemark.sources import readers, row_groups, sinks, tables
from tidemark.streaming import incremental
from tidemark.streaming import jobs as stream_jobs


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "data.json"
    path.write_text(json.dumps([{"conversations": [{"from": "human", "value": "질문"}, {"from": "gpt", "value": "a\nb"}]}] * 3))
    rows = readers.json_records(spark, str(path), schemas.FROM_VALUE_RECORD, multi_line=True).collect()
    assert len(rows) == 3 and rows[0].conversations[0].value == "질문"


def test_metrics_documents_by_folder(spark, tmp_path):
    for tag, loss in (("one", 0.6), ("two", 0.4), ("three", None)):
        (tmp_path / tag).mkdir()
        doc = {"mode": "generic", "run_tag": tag, "stages": {"dataset": 1.25}, "started_at": "2026-01-02T03:04:05.000001Z"}
        doc |= {"training_result": {"train_loss": loss}} if loss else {}
        (tmp_path / tag / "metrics.json").write_text(json.dumps(doc, indent=2))
    docs = readers.metrics_documents(spark, f"{tmp_path}/*/metrics.json")
    assert {r.run_folder: r.run_tag for r in docs.collect()} == {t: t for t in ("one", "two", "three")}
    ranked = [r.run_tag for r in o.leaderboard(docs).orderBy("rank").collect()]
    assert ranked == ["two", "one", "three"]
    assert {(r.run_tag, r.stage, r.seconds) for r in o.stage_rows(docs).collect()} == {(t, "dataset", 1.25) for t in ("one", "two", "three")}


def test_first_existing(spark, tmp_path):
    (tmp_path / "b").mkdir()
    assert readers.first_existing(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]) == f"{tmp_path}/b"
    with pytest.raises(FileNotFoundError):
        readers.first_existing(spark, [f"{tmp_path}/a"])


def test_listing_and_footers(spark):
    rows = {r.file_name: r.n_rows for r in readers.checked_shards(spark, SMALL).collect()}
    assert rows["documents.parquet"] == 200 and rows["region.parquet"] == 5
    assert readers.folder_size(spark, SMALL).head().n_files == len(rows)


def test_built_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert sinks.built_once(spark, f"{tmp_path}/table", build).count() == 3
    assert built == [1]


def test_log_lines(spark, tmp_path):
    (tmp_path / "job-1.log").write_text("a\nb\nc\n")
    rows = j.log_tail(readers.log_lines(spark, f"{tmp_path}/*.log"), 2).orderBy("line_no").collect()
    assert [(r.slug, r.line) for r in rows] == [("job-1", "b"), ("job-1", "c")]


def test_too_little_input_is_refused(spark):
    corpus = p.with_split(tables.corpus(spark, SMALL).filter("shard = 3"), F.lit(3))
    with pytest.raises(ValueError):
        p.require_input(corpus)


def test_leaks_with_and_without_broadcast(spark):
    rows = [("train", "copy")] * 50 + [("val", "copy"), ("val", "own"), ("train", "other")]
    corpus = spark.createDataFrame(rows, "split string, text string")
    for bound in (100, 1):
        assert [(r.n_train, r.n_val) for r in p.leaked_texts(corpus, bound).collect()] == [(50, 1)]


def test_batches_use_stored_positions(spark):
    corpus = readers.text_shards(spark, f"{SMALL}/documents.parquet")
    rows = p.document_batches(corpus, size=64, key="row_index")
    assert [r["count"] for r in rows.groupBy("batch").count().orderBy("batch").collect()] == [64, 64, 64, 8]
    assert "Exchange" not in rows._jdf.queryExecution().toString()


def test_a_broken_shard_fails_loudly(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "x"))
    (tmp_path / "x" / "broken.parquet").write_bytes(b"PAR1 this is no footer PAR1")
    with pytest.raises(Exception, match="broken.parquet"):
        readers.checked_shards(spark, str(tmp_path / "x")).collect()


def test_batches_start_anew_with_each_row_group(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    rows = pa.table({"text": [f"t{i}" for i in range(400)]})
    parquet.write_table(rows, tmp_path / "shard_00000.parquet", row_group_size=200)
    corpus = readers.in_row_groups(readers.text_shards(spark, str(tmp_path)), row_groups.row_groups(spark, str(tmp_path)))
    got = p.document_batches(corpus).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in got] == [128, 72, 128, 72]


def test_endless_epochs_go_on_where_they_stopped(spark, tmp_path):
    import pyarrow as pa
    from pyarrow import parquet

    for shard, n in ((0, 500), (1, 90)):
        rows = pa.table({"doc_id": range(n), "text": [f"{shard}-{i}" for i in range(n)]})
        parquet.write_table(rows, tmp_path / f"shard_{shard}.parquet", row_group_size=200)
    plan = stage(row_groups.epoch_plan(spark, str(tmp_path)))
    listed = [(r.position, r.shard, r.row_group, r.start, r.n_rows, r.first_batch) for r in plan.orderBy("position").collect()]
    assert listed == [(0, "shard_0.parquet", 0, 0, 200, 0), (1, "shard_0.parquet", 1, 200, 200, 2), (2, "shard_0.parquet", 2, 400, 100, 4), (3, "shard_1.parquet", 0, 0, 90, 0)]
    out, progress = staged_path(spark, "epochs"), staged_path(spark, "progress")
    seen = []
    for _ in range(3):  # three row groups of four in each run: two epochs and a quarter
        stream = row_groups.endless_epochs(spark, plan, 3)
        stream.writeStream.option("checkpointLocation", progress).trigger(once=True).start(out).awaitTermination()
        seen.append(spark.read.parquet(out).count())
    assert seen == [500, 500 + 490, 500 + 490 + 390]
    rows = spark.read.parquet(out).collect()
    first = sorted((r.shard, r.row_index, r.text) for r in rows if r.epoch == 1)
    assert first == sorted((f"shard_{s}.parquet", i, f"{s}-{i}") for s, n in ((0, 500), (1, 90)) for i in range(n))
    assert sorted((r.shard, r.row_index, r.text) for r in rows if r.epoch == 2) == first
    assert {r.row_group for r in rows if r.epoch == 3} == {0} and {r.shard for r in rows if r.epoch == 3} == {"shard_0.parquet"}
    batches = Counter((r.shard, r.batch) for r in rows if r.epoch == 1)
    assert batches == {("shard_0.parquet", b): n for b, n in enumerate((128, 72, 128, 72, 100))} | {("shard_1.parquet", 0): 90}


def test_a_task_reads_many_row_groups(spark, tmp_path):
    """As many tasks as cores need, not one task and footer for each row group."""
    import pyarrow as pa
    from pyarrow import parquet

    for shard in range(2):
        parquet.write_table(pa.table({"text": [f"{shard}-{i}" for i in range(500)]}), tmp_path / f"shard_{shard}.parquet", row_group_size=5)
    plan, out = stage(row_groups.epoch_plan(spark, str(tmp_path))), staged_path(spark, "epochs")
    stream = row_groups.endless_epochs(spark, plan, 200)
    stream.writeStream.option("checkpointLocation", staged_path(spark, "progress")).trigger(once=True).start(out).awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted((r.epoch, r.text, r.row_group, r.row_index) for r in rows.collect()) == sorted((1, f"{s}-{i}", i // 5, i) for s in range(2) for i in range(500))
    assert len(list(Path(out.removeprefix("file:")).glob("part-*"))) <= row_groups.TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_a_file_without_a_footer_is_named(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="bad.parquet"):
        row_groups.row_groups(spark, str(tmp_path)).collect()


def test_a_split_is_a_partition_filter(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "train"), (2, "b", "val")], "doc_id int, text string, split string")
    sinks.write_split_corpus(rows, str(tmp_path / "c"))
    val = spark.read.parquet(str(tmp_path / "c")).filter("split = 'val'")
    assert [r.doc_id for r in val.collect()] == [2]
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_planned_shards(spark):
    ids = lambda df: sorted(r.shard for r in df.collect())
    assert ids(p.planned_shards(spark, 3)) == [0, 1, 2, 6542]
    assert ids(p.planned_shards(spark, -1, pinned=9, last=9)) == list(range(10))
    assert ids(p.planned_shards(spark, 50, pinned=9, last=9)) == list(range(10))


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_spread_keeps_rows(spark):
    docs = tables.corpus(spark, SMALL)
    assert readers.spread(docs).count() == docs.count()
    assert readers.spread(docs, split_bytes=1).rdd.getNumPartitions() == docs.rdd.getNumPartitions()


# --------------------------------------------------------------------------- streams in several micro-batches


def in_pieces(spark, rows, order, n):
    """The rows written as ``n`` files in order, read as a stream of one file per micro-batch."""
    path = staged_path(spark, "pieces")
    all_rows = rows.orderBy(*order).collect()
    size = -(-len(all_rows) // n)
    for i in range(n):
        spark.createDataFrame(all_rows[i * size : (i + 1) * size], rows.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def finished(spark, stream, path):
    stream_jobs.write_stream(stream, str(path / "out"), str(path / "progress"))
    return spark.read.parquet(str(path / "out"))


def test_state_changes_stream(spark, tmp_path):
    states = tables.job_states(spark, SMALL)
    got = finished(spark, stream_jobs.state_changes(in_pieces(spark, states, ["at_us", "event_id"], 3)), tmp_path)
    want = j.state_changes(j.until_terminal(states))
    assert pairs(got, "slug", "event_id", "state") == pairs(want, "slug", "event_id", "state")


def test_a_silent_job_is_reported_when_its_time_is_up(spark, tmp_path):
    second = 1_000_000
    rows = [("a", 10, "running"), ("b", 20, "running"), ("b", 1_000, "succeeded"), ("c", 3_000, ""), ("c", 9_000, "running"), ("a", 9_100, "failed")]
    states = spark.createDataFrame([(s, t * second, i, w) for i, (s, t, w) in enumerate(rows)], "slug string, at_us bigint, event_id bigint, state string")
    got = finished(spark, stream_jobs.waited_states(in_pieces(spark, states, ["at_us"], 6), 1_800), tmp_path)
    assert pairs(got, "slug", "state", "timed_out") == [("a", "running", True), ("b", "succeeded", False), ("c", "?", True)]


def test_run_progress_stream(spark, tmp_path):
    log = tables.step_log(spark, SMALL).withColumn("at", F.timestamp_seconds(F.col("step") + 86_400)).cache()
    got = finished(spark, stream_jobs.run_progress(in_pieces(spark, log, ["step", "run_id"], 3)), tmp_path)
    lived = o.smoothed_loss(o.until_diverged(log))
    rounded = F.round("smooth_loss", 9).alias("smooth_loss")
    assert pairs(got, "run_id", "step", rounded) == pairs(lived, "run_id", "step", rounded)


def test_decisions_stream_resumes(spark, tmp_path):
    rows = x.coerce_results(tables.raw_results(spark, SMALL)).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.select("tag", "ts", "event_id", "val_bpb", "status").cache()
    source = in_pieces(spark, rows, ["ts", "event_id"], 3)
    finished(spark, stream_jobs.decisions(source), tmp_path)
    got = finished(spark, stream_jobs.decisions(source), tmp_path)  # nothing new
    assert pairs(got, "tag", "event_id", "decision") == pairs(x.accept_reject(rows), "tag", "event_id", "decision")


def test_metrics_progress_stream(spark, tmp_path):
    marks = tables.stage_events(spark, SMALL).select("run_id", "stage", "at_us", "edge").cache()
    stream = stream_jobs.metrics_progress(in_pieces(spark, marks, ["at_us"], 3))
    stream_jobs.write_updates(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    got = stream_jobs.latest_rows(spark.read.parquet(str(tmp_path / "out")), ["run_id", "stage"])
    known = o.stage_durations(marks).filter("seconds is not null")
    assert pairs(got.filter("seconds is not null"), "run_id", "stage", "seconds") == pairs(known, "run_id", "stage", "seconds")


def test_an_open_key_is_kept_however_long_it_is_silent(spark, tmp_path):
    """60 days pass between pieces; an ended key is forgotten after 30, open ones are not."""
    day = 86_400 * 1_000_000
    rows = [(0, "a", "running"), (0, "b", "succeeded"), (30, "c", "running"), (61, "c", "running"), (61, "a", "running"), (62, "a", "failed")]
    schema = "slug string, at_us bigint, event_id bigint, state string"
    states = spark.createDataFrame([(s, 10**15 + d * day + i, i, w) for i, (d, s, w) in enumerate(rows)], schema)
    got = finished(spark, stream_jobs.state_changes(in_pieces(spark, states, ["at_us"], 6)), tmp_path)
    assert pairs(got, "slug", "state") == [("a", "failed"), ("a", "running"), ("b", "succeeded"), ("c", "running")]


def test_the_best_value_is_kept_however_long_a_tag_is_silent(spark, tmp_path):
    rows = [(1, 0, 1, 1.0), (2, 0, 2, 5.0), (2, 70, 3, 4.0), (1, 71, 4, 2.0), (1, 72, 5, 0.5)]
    data = [(tag, dt.datetime(2024, 1, 1) + dt.timedelta(days=d, seconds=e), e, v, "OK") for tag, d, e, v in rows]
    source = spark.createDataFrame(data, "tag bigint, ts timestamp, event_id bigint, val_bpb double, status string")
    got = finished(spark, stream_jobs.decisions(in_pieces(spark, source, ["ts"], 5)), tmp_path)
    assert pairs(got, "event_id", "decision") == [(1, "KEEP"), (2, "KEEP"), (3, "KEEP"), (4, "DISCARD"), (5, "KEEP")]


def test_keys_are_stored_together_by_hash(spark, tmp_path):
    """Keys share states and calls, none of which sees another's values, also where there is no key."""
    data = [(None if k == 7 else k, 86_400 * 10 + i, k * 10 + i, float((i * k) % 4), "OK") for k in range(2_000) for i in range(4)]
    rows = spark.createDataFrame(data, "tag bigint, s bigint, event_id bigint, val_bpb double, status string")
    rows = rows.select("tag", F.timestamp_seconds("s").alias("ts"), "event_id", "val_bpb", "status")
    got = finished(spark, stream_jobs.decisions(in_pieces(spark, rows, ["ts"], 2)), tmp_path).collect()
    best, want = {}, []
    for tag, _, event, value, _ in sorted(data, key=lambda r: (r[1], r[2])):
        want.append((tag, event, "KEEP" if value < best.get(tag, 9.0) else "DISCARD"))
        best[tag] = min(value, best.get(tag, 9.0))
    assert Counter(map(tuple, got)) == Counter(want)
    states = spark.read.format("statestore").load(str(tmp_path / "progress"))
    assert states.count() <= stream_jobs.GROUPS + 1


def test_time_outs_of_keys_in_one_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_jobs._keyed, "__defaults__", (1,))
    test_a_silent_job_is_reported_when_its_time_is_up(spark, tmp_path / "waits")
    test_an_open_key_is_kept_however_long_it_is_silent(spark, tmp_path / "states")


def test_documents_are_replaced_by_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    save = lambda **docs: sinks.replace_run_documents(spark.createDataFrame(list(docs.items()), "run string, document string"), path)
    read = lambda: {r.run: (r.steps, r.epochs) for r in readers.run_documents(spark, path).select(
        "run", readers.document_value("$.max_steps", "int").alias("steps"), readers.document_value("$.num_epochs", "int").alias("epochs")
    ).collect()}
    save(a='{"max_steps": 60}', b='{"num_epochs": 20}')
    save(a='{"max_steps": 61}')
    save(a='{"max_steps": 61}', c="no document")
    assert read() == {"a": (61, None), "b": (None, 20), "c": (None, None)}


def test_run_documents_stream_resumes(spark, tmp_path):
    marks = tables.stage_events(spark, SMALL).select("run_id", "stage", "at_us", "edge").cache()
    stages = [r.stage for r in marks.select("stage").distinct().collect()]
    path, progress = str(tmp_path / "runs"), str(tmp_path / "progress")
    source = in_pieces(spark, marks, ["at_us"], 3)
    for _ in range(2):
        stream_jobs.write_run_documents(stream_jobs.run_documents(source, stages), path, progress)
    docs = readers.run_documents(spark, path).select(
        readers.document_value("$.run_tag", "bigint").alias("run_id"), readers.document_value("$.stages", "map<string, double>").alias("m")
    )
    got = docs.select("run_id", F.explode("m").alias("stage", "seconds"))
    known = o.stage_durations(marks).filter("seconds is not null")
    assert pairs(got, "run_id", "stage", "seconds") == pairs(known, "run_id", "stage", "seconds")
    assert docs.count() == marks.select("run_id").distinct().count()


def test_listed_lengths_are_those_of_the_file_system(spark):
    files = {p.name: p.stat().st_size for p in Path(SMALL).iterdir()}
    listed = all_queries()["s2_shard_sizes"].run(spark, SMALL).collect()
    assert {r.file_name: r.length for r in listed} == files
    size = all_queries()["s18_folder_mb"].run(spark, SMALL).head()
    assert size.n_files == len(files) and size.total_mb == sum(files.values()) / 2**20


def test_ingest_skips_what_was_taken(spark):
    out, progress = staged_path(spark, "out"), staged_path(spark, "progress")
    for _ in range(2):
        incremental.ingest_once(incremental.new_files(spark, SMALL, "doc_id bigint, text string", "documents.parquet"), out, progress)
    assert spark.read.parquet(out).count() == 200


def test_ingest_of_a_table_of_several_files(spark, tmp_path):
    docs = spark.range(30).selectExpr("id AS doc_id", "'t' AS text", "'src1' AS source")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    taken = all_queries()["x6_ingested_once"].run(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in taken] == [("src1", 30)]


def test_tables_stored_as_folders_of_parts(spark, tmp_path):
    """A table that Spark has written is one entry of its folder, whatever its number of part files."""
    data = tmp_path / "some data+x"
    for name, rows, parts in (("documents", 30, 3), ("b+c", 7, 2), ("none", 0, 1)):
        docs = spark.range(rows).selectExpr("id AS doc_id", "'t' AS text", "'src1' AS source")
        docs.repartition(parts).write.parquet(str(data / f"{name}.parquet"))
    (data / "other.txt").write_text("x")
    sizes = {p.name: sum(f.stat().st_size for f in p.glob("*.parquet")) for p in data.glob("*.parquet")}
    listed = readers.list_files(spark, str(data)).collect()
    assert {r.file_name: r.length for r in listed} == sizes and len(sizes) == 3
    assert all(Path(r.path.removeprefix("file:")).is_dir() for r in listed)
    assert {r.file_name: r.n_rows for r in readers.checked_shards(spark, str(data)).collect()} == {"documents.parquet": 30, "b+c.parquet": 7, "none.parquet": 0}
    assert readers.checked_shards(spark, str(data), "*.nothing").collect() == []


def test_a_save_writes_no_file_per_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs = lambda n, steps: spark.range(n).selectExpr("id AS run", f"concat('{{\"run_tag\": ', id, ', \"steps\": {steps}}}') AS document")
    for n, steps in ((600, 1), (250, 2), (250, 2)):
        sinks.replace_run_documents(runs(n, steps).coalesce(2), path)
    assert len(list(Path(path).rglob("part-*"))) <= 6
    steps = readers.run_documents(spark, path).groupBy(readers.document_value("$.steps", "int").alias("steps")).count()
    assert {r.steps: r["count"] for r in steps.collect()} == {1: 350, 2: 250}
