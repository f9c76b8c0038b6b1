"""Queries over conversations: roles, content, validity, rendering, spans, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import chat as c
from tidemark.plans.staging import staged_path
from tidemark.queries.registry import query
from tidemark.queries.views import CORPUS, FROM_VALUE, UNEVEN, with_views
from tidemark.sources import readers, sinks, tables


def source():
    return F.col("from")


def value():
    return F.col("value")


def uneven_messages(spark, folder):
    return c.without_blank(c.normalise(tables.uneven_turns(spark, folder), c.role_of(source()), value()))


def uneven_facts(spark, folder):
    turns = tables.uneven_turns(spark, folder)
    return c.conversation_facts(turns, c.role_of(source()), value(), source().isNull())


def kept_messages(spark, folder):
    return c.valid_messages(uneven_messages(spark, folder), uneven_facts(spark, folder))


@query("c1_turns_from_value", with_views(FROM_VALUE) + """
SELECT conv_id, turn, CASE "from" WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'model' END AS role, value AS text
FROM from_value WHERE "from" IN ('human', 'gpt')""")
def c1(spark, folder):
    return c.normalise(tables.from_value_turns(spark, folder), c.role_of(source()), value())


@query("c2_turns_role_content", """
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'user' ELSE 'model' END AS role, text
FROM conversations WHERE role IN ('user', 'assistant', 'model')""")
def c2(spark, folder):
    return c.normalise(tables.turns(spark, folder), c.role_of(role=F.col("role")), F.col("text"))


@query("c3_content_text", """
SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN 'None' WHEN turn % 3 = 0 THEN text || ' ' || role || ' '
  ELSE text END AS text FROM conversations""")
def c3(spark, folder):
    rows = tables.json_turns(spark, folder)
    return rows.select("conv_id", "turn", c.content_text(F.col("content")).alias("text"))


@query("c4_malformed", with_views(UNEVEN) + "SELECT conv_id FROM facts WHERE malformed")
def c4(spark, folder):
    turns = tables.uneven_turns(spark, folder)
    return turns.groupBy("conv_id").agg(F.bool_or(source().isNull()).alias("malformed")).filter("malformed").select("conv_id")


@query("c5_without_blank", with_views(UNEVEN) + "SELECT conv_id, turn, role, text FROM messages")
def c5(spark, folder):
    return uneven_messages(spark, folder)


@query("c6_valid_conversations", with_views(UNEVEN) + "SELECT conv_id, n_messages, valid FROM facts")
def c6(spark, folder):
    return uneven_facts(spark, folder).select("conv_id", "n_messages", "valid")


@query("c7_rendered", with_views(UNEVEN) + """
SELECT conv_id, length(string_agg(segment, '' ORDER BY turn)) AS n_chars, string_agg(segment, '' ORDER BY turn) AS text
FROM segments GROUP BY conv_id""")
def c7(spark, folder):
    return c.rendered(kept_messages(spark, folder))


@query("c8_lenient", with_views(FROM_VALUE) + """
SELECT conv_id, turn, CASE "from" WHEN 'human' THEN 'user' ELSE 'model' END AS role, value AS text FROM from_value""")
def c8(spark, folder):
    return c.normalise(tables.from_value_turns(spark, folder), c.lenient_role(source()), value())


@query("c9_kept_texts", with_views(UNEVEN) + """
SELECT conv_id, length(string_agg(segment, '' ORDER BY turn)) AS n_chars, md5(string_agg(segment, '' ORDER BY turn)) AS digest
FROM segments GROUP BY conv_id""")
def c9(spark, folder):
    texts = c.rendered(kept_messages(spark, folder)).filter(F.col("text").isNotNull() & (F.length("text") > 0))
    return texts.select("conv_id", "n_chars", F.md5("text").alias("digest"))


@query("c9_text_parts", with_views(UNEVEN) + """,
placed AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM segments)
SELECT conv_id, CAST(begun // 400 AS BIGINT) AS part, CAST(min(begun) AS BIGINT) AS start, string_agg(segment, '' ORDER BY turn) AS text
FROM placed GROUP BY conv_id, begun // 400""")
def c9_parts(spark, folder):
    """The texts in parts of about 400 characters, written and read again: nothing is left out at any length."""
    path = staged_path(spark, "parts")
    sinks.write_text_parts(c.rendered_parts(kept_messages(spark, folder), part_chars=400, cuts_from=tables.turns(spark, folder)), path)
    return readers.text_parts(spark, path)


@query("c10_target_spans", with_views(UNEVEN) + """,
placed AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY turn
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM segments)
SELECT conv_id, turn, CAST(begun AS BIGINT) AS span_start, CAST(begun + length(opener) AS BIGINT) AS span_end, false AS is_target FROM placed
UNION ALL
SELECT conv_id, turn, CAST(begun + length(opener) AS BIGINT), CAST(begun + length(segment) AS BIGINT), role = 'model' FROM placed""")
def c10(spark, folder):
    return c.target_spans(kept_messages(spark, folder), cuts_from=tables.turns(spark, folder))


@query("c11_standard_schema", """
SELECT conv_id, turn, role, text AS content FROM conversations""")
def c11(spark, folder):
    rows = tables.from_value_turns(spark, folder)
    return rows.select("conv_id", "turn", c.standard_role(source()).alias("role"), value().alias("content"))


@query("c12_holdout", """
WITH mixed AS (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) AS place,
  count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN place <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM mixed""")
def c12(spark, folder):
    return c.holdout(tables.corpus(spark, folder), "doc_id", seed=7).select("doc_id", "part")


@query("a15_dataset_counts", with_views(UNEVEN) + """
SELECT count(*) AS raw_size, count(*) FILTER (valid) AS size, count(*) FILTER (NOT valid) AS filtered_out FROM facts""")
def a15(spark, folder):
    return c.dataset_counts(uneven_facts(spark, folder))


@query("a21_length_report", with_views(CORPUS) + """
SELECT lang, count(*) AS n, min(length(text)) AS shortest, max(length(text)) AS longest, round(avg(length(text)), 4) AS mean
FROM corpus GROUP BY lang""")
def a21(spark, folder):
    size = F.length("text").cast("bigint")
    return tables.corpus(spark, folder).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(size).alias("shortest"),
        F.max(size).alias("longest"),
        F.round(F.avg(size), 4).alias("mean"),
    )


@query("p8_preview", """
SELECT doc_id, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview FROM documents""")
def p8(spark, folder):
    return tables.corpus(spark, folder).select("doc_id", t.preview(F.col("text")).alias("preview"))


@query("p20_prompt_response", """
SELECT conv_id, max(text) FILTER (turn = 0) AS prompt, max(text) FILTER (turn = 1) AS response
FROM conversations GROUP BY conv_id""")
def p20(spark, folder):
    return c.prompt_response(tables.turns(spark, folder))


@query("p21_size_band", """
SELECT lang, n, CASE WHEN n < 100 THEN 'below 100' WHEN n BETWEEN 1000 AND 5000 THEN '1000 to 5000'
  WHEN n > 5000 THEN 'above 5000' ELSE 'unspecified' END AS band
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""")
def p21(spark, folder):
    counts = tables.corpus(spark, folder).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("band", c.size_band(F.col("n")))


@query("p23_record_check", with_views(UNEVEN) + """
SELECT conv_id, CASE WHEN bool_and("from" IS NOT NULL AND value IS NOT NULL) THEN NULL
  ELSE 'turn without from or value' END AS problem FROM uneven GROUP BY conv_id""")
def p23(spark, folder):
    turns = tables.uneven_turns(spark, folder)
    complete = F.bool_and(source().isNotNull() & value().isNotNull())
    return turns.groupBy("conv_id").agg(F.when(~complete, "turn without from or value").alias("problem"))
