"""Queries over the document corpus: shards, splits, budgets, pre-tokens, batches, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import tokens as k
from tidemark.functions.text import PERSONAL_DATA, collapse
from tidemark.operators import corpus as p
from tidemark.plans.staging import stage, staged_path
from tidemark.queries.registry import query
from tidemark.queries.views import CORPUS, with_views
from tidemark.sources import readers, row_groups, sinks, tables

BUDGET = 1_000_000
FIRST_N = 300
PLANNED = 15

# The same pattern for an engine without possessive marks and look-ahead; equal on text with collapsed white space.
COLLAPSED_PATTERN = (
    r"''(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]|\s+"
)
WORDS = CORPUS + f""",
words AS (SELECT doc_id, shard, regexp_extract_all(regexp_replace(text, '\\s+', ' ', 'g'), '{COLLAPSED_PATTERN}') AS w FROM corpus)"""


def split_corpus(spark, folder):
    rows = tables.corpus(spark, folder)
    return p.with_split(rows, p.last_shard(rows))


def plan(spark, folder):
    rows = tables.corpus(spark, folder)
    return p.planned_shards(spark, PLANNED, p.last_shard(rows) + 3)


SHARDS = CORPUS + f""",
pinned AS (SELECT max(shard) + 3 AS shard FROM corpus),
planned AS (SELECT CAST(range AS INT) AS shard FROM range({PLANNED}) UNION SELECT shard FROM pinned),
present AS (SELECT shard, count(*) AS n_docs FROM corpus GROUP BY shard),
manifest AS (SELECT p.shard, printf('shard_%05d.parquet', p.shard) AS file_name, p.shard = (SELECT shard FROM pinned) AS is_val,
  n_docs IS NOT NULL AS present, coalesce(n_docs, 0) AS n_docs FROM planned p LEFT JOIN present s ON p.shard = s.shard)"""


@query("s1_text_scan", """
SELECT 'documents.parquet' AS shard, doc_id AS row_index, length(text) AS n_chars, md5(text) AS digest FROM documents""")
def s1(spark, folder):
    rows = readers.text_shards(spark, f"{folder}/documents.parquet")
    return rows.select("shard", "row_index", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
          "orders", "pages", "part", "region", "supplier")


@query("s2_list_shards", "SELECT file_name, true AS holds_bytes FROM (VALUES " + ", ".join(
    f"('{name}.parquet')" for name in TABLES) + ") t(file_name)")
def s2(spark, folder):
    return readers.list_files(spark, folder, "*.parquet").select("file_name", (F.col("length") > 0).alias("holds_bytes"))


@query("s2_shard_sizes")
def s2_sizes(spark, folder):
    """The length of each file; the tests compare it with the file system."""
    return readers.list_files(spark, folder, "*.parquet").select("file_name", "length")


@query("s3_plan_shards", with_views(SHARDS) + "SELECT * FROM manifest")
def s3(spark, folder):
    rows = tables.corpus(spark, folder)
    return p.manifest(plan(spark, folder), p.present_shards(rows), p.last_shard(rows) + 3)


@query("s4_missing_shards", with_views(SHARDS) + "SELECT shard, file_name FROM manifest WHERE NOT present")
def s4(spark, folder):
    return p.missing_shards(plan(spark, folder), p.present_shards(tables.corpus(spark, folder)))


@query("s5_completeness", with_views(SHARDS) + "SELECT count(*) FILTER (present) AS ok, count(*) AS total FROM manifest")
def s5(spark, folder):
    return p.completeness(s3(spark, folder))


@query("s6_input_guard", with_views(CORPUS) + """
SELECT count(DISTINCT shard) AS n_shards, CAST(sum(CASE WHEN shard < top THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
  CAST(sum(CASE WHEN shard = top THEN 1 ELSE 0 END) AS BIGINT) AS n_val, true AS enough
FROM corpus, (SELECT max(shard) AS top FROM corpus)""")
def s6(spark, folder):
    return p.input_facts(p.require_input(split_corpus(spark, folder)))


@query("s9_first_documents", with_views(CORPUS) + f"""
SELECT shard, doc_id FROM corpus ORDER BY shard, doc_id LIMIT {FIRST_N}""")
def s9(spark, folder):
    return p.first_documents(tables.corpus(spark, folder), FIRST_N).select("shard", "doc_id")


@query("u1_planned_union", with_views(SHARDS) + "SELECT shard FROM planned")
def u1(spark, folder):
    return plan(spark, folder).select("shard")


@query("j5_planned_not_present", with_views(SHARDS) + """
SELECT count(*) AS needed, (SELECT count(*) FROM planned) - count(*) AS existing FROM manifest WHERE NOT present""")
def j5(spark, folder):
    planned = plan(spark, folder)
    gone = p.missing_shards(planned, p.present_shards(tables.corpus(spark, folder)))
    total = planned.agg(F.count(F.lit(1))).scalar()
    return gone.agg(F.count(F.lit(1)).alias("needed")).withColumn("existing", total - F.col("needed"))


@query("p1_split", with_views(CORPUS) + """
SELECT doc_id, shard, CASE WHEN shard = (SELECT max(shard) FROM corpus) THEN 'val' ELSE 'train' END AS split FROM corpus""")
def p1(spark, folder):
    return split_corpus(spark, folder).select("doc_id", "shard", "split")


@query("p1_split_folders", with_views(CORPUS) + """
SELECT doc_id, shard, length(text) AS n_chars FROM corpus WHERE shard = (SELECT max(shard) FROM corpus)""")
def p1_folders(spark, folder):
    """The validation split of a corpus stored by split; the scan reads that folder only."""
    path = staged_path(spark, "split-corpus")
    sinks.write_split_corpus(split_corpus(spark, folder), path)
    val = spark.read.parquet(path).filter("split = 'val'")
    return val.select("doc_id", "shard", F.length("text").cast("bigint").alias("n_chars"))


@query("p2_document_cap", "SELECT doc_id, length(text) AS n_chars, md5(substr(text, 1, 10000)) AS digest FROM documents")
def p2(spark, folder):
    return tables.corpus(spark, folder).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5(k.capped(F.col("text"))).alias("digest")
    )


@query("p24_personal_data", "SELECT doc_id, " + ", ".join(
    f"len(regexp_extract_all(text, '{form}')) AS n_{kind}" for kind, form in PERSONAL_DATA.items()
) + ", " + " + ".join(f"len(regexp_extract_all(text, '{form}'))" for form in PERSONAL_DATA.values()) + " > 0 AS flagged FROM documents")
def p24(spark, folder):
    rows = p.personal_data(tables.texts(spark, folder).select("doc_id", "text"))
    return rows.drop("text")


@query("t1_char_budget", with_views(CORPUS) + f"""
, train AS (SELECT * FROM corpus WHERE shard < (SELECT max(shard) FROM corpus))
SELECT doc_id, length(capped) AS n_chars, md5(capped) AS digest FROM (
  SELECT doc_id, substr(text, 1, 10000) AS capped, coalesce(sum(length(substr(text, 1, 10000))) OVER (ORDER BY shard, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM train) WHERE before < {BUDGET}""")
def t1(spark, folder):
    train = split_corpus(spark, folder).filter("split = 'train'")
    rows = p.character_budget(train, BUDGET)
    return rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query("t2_pretokens", with_views(WORDS) + """
SELECT doc_id, len(w) AS n_words, md5(array_to_string(w, '|')) AS digest FROM words""")
def t2(spark, folder):
    words = k.pretokens(collapse(F.col("text")))
    return tables.texts(spark, folder).select("doc_id", words.alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("n_words"), F.md5(F.array_join("w", "|")).alias("digest")
    )


@query("t2_pretokens_lossless", "SELECT doc_id, md5(text) AS digest FROM documents")
def t2_lossless(spark, folder):
    joined = F.array_join(k.pretokens(F.col("text")), "")
    return tables.texts(spark, folder).select("doc_id", F.md5(joined).alias("digest"))


@query("t3_word_counts", with_views(WORDS) + """
SELECT word, count(*) AS cnt FROM (SELECT unnest(w) AS word FROM words) GROUP BY word""")
def t3(spark, folder):
    return p.word_counts(tables.texts(spark, folder), collapse(F.col("text")))


@query("t11_document_batches", with_views(CORPUS) + """
, numbered AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS row_index FROM corpus)
SELECT e.range AS epoch, shard, row_index // 128 AS batch, count(*) AS n_docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM numbered, range(1, 3) e GROUP BY 1, 2, 3""")
def t11(spark, folder):
    rows = p.document_batches(tables.corpus(spark, folder).select("shard", "doc_id"), epochs=2)
    return rows.groupBy(F.col("epoch").cast("bigint").alias("epoch"), "shard", "batch").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


@query("t11_row_group_batches", with_views(CORPUS) + """
SELECT count(*) AS n_docs, true AS within_size, true AS groups_start_anew, true AS several_groups FROM corpus""")
def t11_row_groups(spark, folder):
    """Batches of shards that are written with several row groups each and read back."""
    path = staged_path(spark, "shards")
    rows = tables.corpus(spark, folder).select("shard", "doc_id", "text").repartition("shard").sortWithinPartitions("shard", "doc_id")
    rows.write.option("parquet.block.size", 65_536).option("parquet.page.size.row.check.min", 1).parquet(path)
    stored = readers.in_row_groups(readers.text_shards(spark, path).drop("text"), row_groups.row_groups(spark, path))
    batches = p.document_batches(stored).groupBy("shard", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("row_group").alias("groups"), F.min("group_row").alias("first")
    )
    groups = stored.agg(F.countDistinct("shard", "row_group").alias("groups"), F.countDistinct("shard").alias("shards"))
    facts = batches.agg(
        F.sum("n").alias("n_docs"),
        (F.max("n") <= p.DOCS_PER_BATCH).alias("within_size"),
        F.bool_and((F.col("groups") == 1) & (F.col("first") % p.DOCS_PER_BATCH == 0)).alias("groups_start_anew"),
    )
    return facts.crossJoin(groups).select(  # one row each
        "n_docs", "within_size", "groups_start_anew", (F.col("groups") > F.col("shards")).alias("several_groups")
    )


@query("t11_endless_epochs", with_views(CORPUS) + """
SELECT e.range AS epoch, shard, count(*) AS n_docs, count(*) AS n_rows, sum(length(text)) AS n_chars
FROM corpus, range(1, 3) e GROUP BY 1, 2""")
def t11_endless(spark, folder):
    """The first two epochs of an endless stream over row groups that is stopped and started again after each micro-batch."""
    shards, out, progress = (staged_path(spark, name) for name in ("shards", "epochs", "progress"))
    rows = tables.corpus(spark, folder).select("shard", "doc_id", "text").repartition("shard").sortWithinPartitions("shard", "doc_id")
    rows.write.option("parquet.block.size", 65_536).option("parquet.page.size.row.check.min", 1).partitionBy("shard").parquet(shards)
    plan = stage(row_groups.epoch_plan(spark, f"{shards}/*"), "plan")
    size = max(8, -(-plan.count() // 2))
    runs = -(-2 * plan.count() // size)
    for _ in range(runs):
        stream = row_groups.endless_epochs(spark, plan, size)
        stream.writeStream.option("checkpointLocation", progress).trigger(once=True).start(out).awaitTermination()
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("bigint").alias("shard")
    return spark.read.parquet(out).filter("epoch <= 2").groupBy("epoch", shard).agg(
        F.count(F.lit(1)).alias("n_docs"), F.countDistinct("path", "row_index").alias("n_rows"), F.sum(F.length("text")).alias("n_chars")
    )


@query("p19_input_target_shift", with_views(WORDS) + """
SELECT doc_id, md5(array_to_string(w[1:len(w)-1], '|')) AS inputs, md5(array_to_string(w[2:], '|')) AS targets FROM words""")
def p19(spark, folder):
    words = k.pretokens(collapse(F.col("text")))
    rows = tables.texts(spark, folder).select("doc_id", words.alias("w"))
    return rows.select(
        "doc_id",
        F.md5(F.array_join(k.inputs(F.col("w")), "|")).alias("inputs"),
        F.md5(F.array_join(k.targets(F.col("w")), "|")).alias("targets"),
    )


@query("j8_split_leaks", with_views(CORPUS) + """
, split AS (SELECT text, shard = (SELECT max(shard) FROM corpus) AS is_val FROM corpus)
SELECT sha256(text) AS text_hash, count(*) FILTER (NOT is_val) AS n_train, count(*) FILTER (is_val) AS n_val
FROM split GROUP BY text HAVING bool_or(is_val) AND NOT bool_and(is_val)""")
def j8(spark, folder):
    return p.leaked_texts(split_corpus(spark, folder))
