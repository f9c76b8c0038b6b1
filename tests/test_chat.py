"""Conversation rules on hand-made cases, in both forms."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import chat as c
from tidemark.sources import readers, sinks

U, M = "<|turn>user\n", "<|turn>model\n"
END = "<turn|>\n"


def fv(*turns):
    return [{"from": w, "value": t, "role": None, "content": None} for w, t in turns]


def rc(*turns):
    return [{"from": None, "value": None, "role": w, "content": t} for w, t in turns]


RECORDS = {
    "plain": (fv(("human", "a"), ("gpt", "b")), f"{U}a{END}{M}b{END}"),
    "roles": (rc(("system", "s"), ("user", "a"), ("assistant", "b"), ("tool", "x")), f"{U}a{END}{M}b{END}"),
    "ends on user": (fv(("human", "a"), ("model", "b"), ("human", "c")), f"{U}a{END}{M}b{END}{U}c{END}"),
    "single": (fv(("human", "a")), None),
    "model first": (fv(("gpt", "b"), ("human", "a")), None),
    "two users": (rc(("user", "a"), ("user", "b"), ("model", "c")), None),
    "blank turn joins users": (fv(("human", "a"), ("gpt", "  \n"), ("human", "c")), None),
    "blank only": (fv(("human", " "), ("gpt", "\t")), None),
    "neither key": (fv(("human", "a"), ("gpt", "b")) + [{"from": None, "value": "x", "role": None, "content": None}], None),
    "empty": ([], None),
    "unknown dropped": (fv(("human", "a"), ("function", "f"), ("gpt", "b")), f"{U}a{END}{M}b{END}"),
    "from wins": ([{"from": "human", "value": "a", "role": "assistant", "content": "z"}] + fv(("gpt", "b")), f"{U}a{END}{M}b{END}"),
}
SCHEMA = "name string, conversations array<struct<from: string, value: string, role: string, content: string>>"


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([(n, conv) for n, (conv, _) in RECORDS.items()], SCHEMA)


def test_record_text(records):
    messages = c.record_messages(F.col("conversations"))
    got = {r.name: r.text for r in records.select("name", c.record_text(messages).alias("text")).collect()}
    assert got == {n: text for n, (_, text) in RECORDS.items()}


@pytest.mark.parametrize("per_slice", ["1000000", "3"])
def test_turn_tables_agree_with_records(spark, records, per_slice):
    spark.conf.set("tidemark.rowsPerSlice", per_slice)
    turns = records.select(F.col("name").alias("conv_id"), F.posexplode("conversations").alias("turn", "t")).select("conv_id", "turn", "t.*")
    role = c.role_of(F.col("from"), F.col("role"))
    text = F.when(F.col("from").isNotNull(), F.col("value")).otherwise(F.col("content"))
    facts = c.conversation_facts(turns, role, text, F.col("from").isNull() & F.col("role").isNull())
    messages = c.valid_messages(c.without_blank(c.normalise(turns, role, text)), facts)
    got = {r.conv_id: r.text for r in c.rendered(messages).collect()}
    spark.conf.unset("tidemark.rowsPerSlice")
    assert got == {n: t for n, (_, t) in RECORDS.items() if t is not None}
    counts = c.dataset_counts(facts).head()
    assert (counts.raw_size, counts.size) == (len(RECORDS) - 1, len(got))  # "empty" has no turns


def test_long_conversation_is_one_row_or_listed(spark):
    turns = [(k, i, "user" if i % 2 == 0 else "model", "x" * 50) for k, n in ((1, 40), (2, 2)) for i in range(n)]
    messages = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    whole = "".join((U if i % 2 == 0 else M) + "x" * 50 + END for i in range(40))
    got = {r.conv_id: r for r in c.rendered(messages).collect()}
    assert len(got) == 2 and got[1].text == whole
    got = {r.conv_id: r for r in c.rendered(messages, max_chars=300).collect()}
    assert len(got) == 2 and got[1].text is None and got[1].n_chars == len(whole) and got[2].text


def test_list_content_in_a_record(spark, tmp_path):
    parts = [{"type": "text", "text": "hi"}, {"type": "image", "text": "no"}]
    turns = [{"role": "user", "content": parts}, {"role": "assistant", "content": '[{"type": "text", "text": "as typed"}]'}]
    (tmp_path / "r.json").write_text(json.dumps({"conversations": turns}) + "\n")
    rows = readers.json_records(spark, str(tmp_path), schemas.RECORD)
    got = rows.select(c.record_text(c.record_messages(F.col("conversations"), c.variant_text)).alias("t")).head().t
    assert got == U + "hi" + END + M + '[{"type": "text", "text": "as typed"}]' + END


def test_leading_bos_is_dropped(spark):
    row = spark.createDataFrame([("<bos>abc",), ("a<bos>",)], "t string").select(c.without_bos(F.col("t")).alias("t"))
    assert [r.t for r in row.collect()] == ["abc", "a<bos>"]


def test_content_text(spark):
    cases = {
        "plain": ("hi there", "hi there"),
        "parts": ([{"type": "text", "text": "a"}, {"type": "image", "text": "no"}, "bare", {"type": "text"}, {"type": "text", "text": "b"}], "a  b"),
        "none": (None, "None"),
        "number": (5, "5"),
        "empty list": ([], ""),
        "quotes": ('say "x"\n', 'say "x"\n'),
    }
    df = spark.createDataFrame([(n, json.dumps(v)) for n, (v, _) in cases.items()], "n string, v string")
    got = {r.n: r.t for r in df.select("n", c.content_text(F.col("v")).alias("t")).collect()}
    assert got == {n: t for n, (_, t) in cases.items()}


def test_target_spans_and_labels(spark):
    messages = spark.createDataFrame([(1, 0, "user", "ab"), (1, 1, "model", "cd")], "conv_id int, turn int, role string, text string")
    text = f"{U}ab{END}{M}cd{END}"
    spans = c.target_spans(messages)
    on = [text[r.span_start : r.span_end] for r in spans.filter("is_target").orderBy("span_start").collect()]
    assert on == ["cd" + END]
    tokens = spark.createDataFrame([(1, i, i, 100 + i) for i in range(len(text))], "conv_id int, pos int, char_start int, token_id int")
    labels = [r.label for r in c.masked_labels(tokens, spans).orderBy("pos").collect()]
    begin = text.index("cd")
    assert labels == [-1 if i < begin else 100 + i for i in range(len(text))]


def test_lenient_and_problem(spark, records):
    got = records.filter("name = 'unknown dropped'").select(c.lenient_record(F.col("conversations")).alias("m")).head().m
    assert [m.role for m in got] == ["user", "model", "model"]
    problems = {r.name: r.p for r in records.select("name", c.record_problem(F.col("conversations")).alias("p")).collect()}
    assert problems["plain"] is None and problems["empty"] == "no turns" and "without" in problems["neither key"]


def test_holdout_is_exact(spark):
    df = spark.range(103)
    for per_slice in ("1000000", "10"):
        spark.conf.set("tidemark.rowsPerSlice", per_slice)
        parts = c.holdout(df, "id", seed=3).groupBy("part").count().collect()
        assert {r.part: r["count"] for r in parts} == {"train": 82, "test": 21}
    spark.conf.unset("tidemark.rowsPerSlice")


def test_size_bands(spark):
    df = spark.createDataFrame([(99,), (100,), (1000,), (5000,), (5001,)], "n int").select(c.size_band(F.col("n")).alias("b"))
    assert [r.b for r in df.collect()] == ["below 100", "unspecified", "1000 to 5000", "1000 to 5000", "above 5000"]


def test_text_parts_join_to_the_rendered_text(spark, tmp_path, tiny_slices):
    rows = [(c, t, ("user", "model")[t % 2], f"{c}-{t} " * (1 + (c * t) % 7)) for c in range(6) for t in range(0, 300 if c == 2 else 9)]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    path = str(tmp_path / "parts")
    sinks.write_text_parts(c.rendered_parts(messages, part_chars=100), path)
    whole = {r.conv_id: r.text for r in c.rendered(messages).collect()}
    parts = readers.text_parts(spark, path).orderBy("conv_id", "part").collect()
    for conv, text in whole.items():
        own = [p for p in parts if p.conv_id == conv]
        assert "".join(p.text for p in own) == text
        assert all(p.start // 100 == p.part and text[p.start :].startswith(p.text) for p in own)
    assert len([p for p in parts if p.conv_id == 2]) > 20
    assert readers.text_parts(spark, path, 2).orderBy("part").collect() == [p for p in parts if p.conv_id == 2]
    assert c.rendered(messages, max_chars=500).filter("text is null").count() >= 1  # its parts are all there
