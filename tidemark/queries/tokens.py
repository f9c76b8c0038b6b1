"""Queries over the byte-pair vocabulary, encoded documents and packed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import collapse
from tidemark.functions.tokens import inputs, targets
from tidemark.operators import bpe
from tidemark.operators import corpus as p
from tidemark.operators import evaluation as ev
from tidemark.operators import packing
from tidemark.plans.staging import stage, staged_path
from tidemark.queries.corpus import WORDS, split_corpus
from tidemark.queries.registry import query
from tidemark.queries.views import CORPUS, with_views
from tidemark.session import shared_dir
from tidemark.sources import readers, sinks, tables

MERGES = 7_932  # with 256 bytes and 4 special tokens: 8,192 ids
ROW_TOKENS = 2_049
BATCH_ROWS, EVAL_BUDGET = 4, 20_971_520
MERGE_ROWS = "rank int, left_id int, right_id int"


def vocabulary_name(spark, folder):
    """The number of merges and a digest of the documents that they are trained on."""
    rows = tables.corpus(spark, folder)
    digest = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("shard", "doc_id", "text").cast("decimal(38,0)"))).head()
    return f"{MERGES}-{digest[0]}-{digest[1]}"


def merges(spark, folder):
    """Merges trained on the training split within the character budget.

    They are a stored table in the shared folder, found again by ``vocabulary_name``.
    """

    def train():
        train = split_corpus(spark, folder).filter("split = 'train'")
        words = p.word_counts(readers.spread(p.character_budget(train)), F.col("text"))
        return spark.createDataFrame([(i, *pair) for i, pair in enumerate(bpe.train(words, MERGES))], MERGE_ROWS)

    stored = sinks.built_once(spark, f"{shared_dir(spark)}/merges-{vocabulary_name(spark, folder)}", train)
    return [(r.left_id, r.right_id) for r in stored.orderBy("rank").collect()]  # as many rows as there are merges


def vocabulary(spark, folder):
    return bpe.vocabulary(spark, merges(spark, folder))


def encoded(spark, folder):
    """The encoded corpus, a stored table like the vocabulary: several queries read it."""
    ids = bpe.encoded(F.col("text"), merges(spark, folder))
    rows = tables.texts(spark, folder).select("doc_id", "text", ids.alias("ids"))
    return sinks.built_once(spark, f"{shared_dir(spark)}/encoded-{vocabulary_name(spark, folder)}", lambda: rows)


def packed(spark, folder, split):
    known = merges(spark, folder)
    docs = split_corpus(spark, folder).filter(F.col("split") == split).select("shard", "doc_id", "text")
    ids = bpe.encoded(F.col("text"), known, bpe.bos_id(known))
    return packing.packed(p.document_batches(docs), ids, ROW_TOKENS)


def packed_rows(spark, folder, split):
    """The rows of one loader over a split, a stored table that a trainer reads and several queries use."""
    known = merges(spark, folder)

    def rows():
        docs = split_corpus(spark, folder).filter(F.col("split") == split).select("shard", "doc_id", "text")
        ids = bpe.encoded(F.col("text"), known, bpe.bos_id(known))
        tokens = stage(readers.spread(docs).select("shard", "doc_id", ids.alias("ids")), "tokens")  # before the few shards are put in order
        return packing.packed_in_order(p.document_batches(tokens), F.col("ids"), ROW_TOKENS)

    return sinks.built_once(spark, f"{shared_dir(spark)}/packed-{split}-{ROW_TOKENS}-{vocabulary_name(spark, folder)}", rows)


@query("t4_pair_counts", with_views(WORDS) + """
, counts AS (SELECT hex(encode(word)) AS h, count(*) AS cnt FROM (SELECT unnest(w) AS word FROM words) GROUP BY word)
SELECT pair, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
  SELECT substr(h, 2 * i - 1, 4) AS pair, cnt FROM (SELECT h, cnt, unnest(range(1, length(h) // 2)) AS i FROM counts)) GROUP BY pair""")
def t4_pairs(spark, folder):
    words = p.word_counts(tables.texts(spark, folder), collapse(F.col("text")))
    pairs = bpe.pair_counts(words.select(bpe.as_symbols(F.col("word")).alias("symbols"), "cnt"))
    return pairs.select(F.hex(F.encode("pair", "ISO-8859-1")).alias("pair"), "cnt")


# What must hold of any vocabulary, whatever its merges.
IDS = f"(SELECT range AS token_id FROM range({256 + MERGES + 4}))"


@query("t4_merges")
def t4(spark, folder):
    rows = vocabulary(spark, folder).filter("left_id is not null")
    return rows.select((F.col("token_id") - bpe.FIRST_MERGED).alias("rank"), "left_id", "right_id")


@query("t5_vocabulary")
def t5(spark, folder):
    return vocabulary(spark, folder).select("token_id", F.hex("token").alias("token"), "is_special", "left_id", "right_id")


@query("t6_token_bytes")
def t6(spark, folder):
    return vocabulary(spark, folder).select("token_id", "n_bytes", "raw_bytes")


@query("t6_vocabulary_invariants", f"""
SELECT count(*) AS n_tokens, count(*) FILTER (token_id >= {256 + MERGES}) AS n_special, CAST({MERGES} AS BIGINT) AS n_merged,
  true AS bytes_come_first, true AS parts_come_before, true AS lengths_add_up FROM {IDS}""")
def t6_invariants(spark, folder):
    """Single bytes first, then tokens made of two earlier ones whose lengths add up, then the special ones."""
    rows = vocabulary(spark, folder)
    part = lambda side: rows.select(F.col("token_id").alias(f"{side}_id"), F.col("raw_bytes").alias(f"{side}_bytes"))
    joined = rows.join(part("left"), "left_id", "left").join(part("right"), "right_id", "left")
    merged = F.col("left_id").isNotNull()
    return joined.agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.count_if("is_special").alias("n_special"),
        F.count_if(merged).alias("n_merged"),
        F.bool_and((F.col("token_id") >= 256) | (F.hex("token") == F.lpad(F.hex("token_id"), 2, "0"))).alias("bytes_come_first"),
        F.bool_and(~merged | (F.greatest("left_id", "right_id") < F.col("token_id"))).alias("parts_come_before"),
        F.bool_and(~merged | (F.col("raw_bytes") == F.col("left_bytes") + F.col("right_bytes"))).alias("lengths_add_up"),
    )


@query("t7_encoded_bytes", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def t7_bytes(spark, folder):
    """The bytes of a document's tokens are those of its text."""
    return encoded(spark, folder).select("doc_id", bpe.bytes_of(F.col("ids"), merges(spark, folder)).alias("n_bytes"))


@query("t7_encoded")
def t7(spark, folder):
    return encoded(spark, folder).select(
        "doc_id", F.size("ids").alias("n_tokens"), F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("digest")
    )


@query("t7_token_counts")
def t7_counts(spark, folder):
    words = p.word_counts(tables.texts(spark, folder), F.col("text"))
    return bpe.token_counts(words, merges(spark, folder))


@query("t8_decoded", "SELECT doc_id, md5(text) AS digest FROM documents")
def t8(spark, folder):
    text = bpe.decoded(F.col("ids"), merges(spark, folder))
    return encoded(spark, folder).select("doc_id", F.md5(text).alias("digest"))


@query("t9_round_trip", "SELECT count(*) AS n_docs, CAST(0 AS BIGINT) AS n_changed FROM documents")
def t9(spark, folder):
    text = bpe.decoded(F.col("ids"), merges(spark, folder))
    return encoded(spark, folder).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(~F.col("text").eqNullSafe(text)).alias("n_changed")
    )


@query("t10_vocab_size", f"SELECT CAST({256 + MERGES + 4} AS INT) AS n_vocab, CAST({256 + MERGES} AS INT) AS bos_id")
def t10(spark, folder):
    return bpe.vocab_size(vocabulary(spark, folder))


@query("s15_vocabulary_table", f"""
SELECT is_special, count(*) AS n FROM (SELECT range >= {256 + MERGES} AS is_special FROM range({256 + MERGES + 4})) GROUP BY is_special""")
def s15(spark, folder):
    path = staged_path(spark, "vocabulary")
    sinks.built_once(spark, path, lambda: vocabulary(spark, folder))
    rows = sinks.built_once(spark, path, lambda: vocabulary(spark, folder))
    return rows.groupBy("is_special").agg(F.count(F.lit(1)).alias("n"))


@query("j1_token_bytes", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS raw_bytes FROM documents WHERE text <> ''")
def j1(spark, folder):
    rows = encoded(spark, folder).filter("text <> ''")
    return rows.select("doc_id", bpe.bytes_of(F.col("ids"), merges(spark, folder)).alias("raw_bytes"))


@query("a1_packed_bits_per_byte")
def a1_packed(spark, folder):
    vocab = vocabulary(spark, folder)
    counts = t7_counts(spark, folder)
    total = counts.agg(F.sum("cnt")).scalar()
    nats = counts.select("token_id", (-F.log(F.col("cnt") / total)).alias("nats"))
    # Both tables have one row per token of the vocabulary.
    losses = vocab.join(nats, "token_id", "left").withColumn("nats", F.coalesce("nats", F.lit(0.0)))
    rows = packed_rows(spark, folder, "val").select(F.explode(targets(F.col("tokens"))).alias("token_id"))
    seen = rows.groupBy("token_id").agg(F.count(F.lit(1)).alias("times")).join(F.broadcast(losses), "token_id")
    out = ev.bits_per_byte(seen, F.col("nats"), F.col("n_bytes"), weight=F.col("times"))
    return out.select("n_bytes", F.round("bpb", 6).alias("bpb"))


@query("t12_packed_rows")
def t12(spark, folder):
    return packed_rows(spark, folder, "train").select(
        "packer_id", "row_id", "epoch", "drain", "docs", "cropped", F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join(F.col("tokens").cast("array<string>"), " ")).alias("digest"),
    )


@query("t13_packing_report")
def t13(spark, folder):
    out = packing.packing_report(packed_rows(spark, folder, "train"), ROW_TOKENS, bpe.bos_id(merges(spark, folder)))
    return out.withColumn("docs_per_row", F.round("docs_per_row", 6))


@query("t13_packing_invariants", with_views(CORPUS) + f"""
SELECT true AS all_full, true AS all_begin_a_document, true AS placed_at_most_all, true AS tokens_add_up,
  least({packing.PACKERS}, CAST(sum(batches) AS BIGINT)) AS packers
FROM (SELECT (count(*) + 127) // 128 AS batches FROM corpus WHERE shard < (SELECT max(shard) FROM corpus) GROUP BY shard)""")
def t13_invariants(spark, folder):
    """Rows are full and begin with a document; their tokens and the cut ones are at most those of the split."""
    known = merges(spark, folder)
    rows = stage(packed(spark, folder, "train"), "packed")
    train = split_corpus(spark, folder).filter("split = 'train'")
    had = train.agg(F.sum(F.size(bpe.encoded(F.col("text"), known)) + 1).alias("had"), F.count(F.lit(1)).alias("n"))
    docs = train.select("shard", "doc_id")
    made = packing.with_packer(p.document_batches(docs), packing.PACKERS).agg(F.countDistinct("packer").alias("packers"))
    report = packing.packing_report(rows, ROW_TOKENS, bpe.bos_id(known))
    used = F.col("n_rows") * ROW_TOKENS + F.coalesce("cropped_tokens", F.lit(0))
    return report.crossJoin(had).crossJoin(made).select(  # one row each
        (F.col("full_rows") == F.col("n_rows")).alias("all_full"),
        (F.col("bos_rows") == F.col("n_rows")).alias("all_begin_a_document"),
        (F.coalesce("placed_docs", F.lit(0)) <= F.col("n")).alias("placed_at_most_all"),
        (used <= F.col("had")).alias("tokens_add_up"),
        "packers",
    )

@query("t14_evaluation_rows")
def t14(spark, folder):
    rows = packed_rows(spark, folder, "val").select("packer_id", "row_id", F.size("tokens").alias("n_tokens"))
    return packing.evaluation_rows(rows, BATCH_ROWS, EVAL_BUDGET, ROW_TOKENS - 1)


@query("f4_packed_inputs")
def f4(spark, folder):
    tokens = F.col("tokens")
    return packed_rows(spark, folder, "val").select(
        "packer_id",
        "row_id",
        F.size(inputs(tokens)).alias("n_inputs"),
        F.md5(F.array_join(inputs(tokens).cast("array<string>"), " ")).alias("inputs"),
        F.md5(F.array_join(targets(tokens).cast("array<string>"), " ")).alias("targets"),
        "epoch",
    )
