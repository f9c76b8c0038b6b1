"""Pre-tokens, byte-pair training, encoding and packing against small independent models."""

import random
import time
from collections import Counter

import numpy as np
import pytest
import regex
import tiktoken
from conftest import SMALL
from pyspark.sql import functions as F

from tidemark.functions.tokens import SPLIT_PATTERN, pretokens
from tidemark.operators import bpe, packing
from tidemark.operators import merges as trainer
from tidemark.operators.corpus import document_batches, word_counts

HAND_MADE = [
    "Hello world! Numbers: 123. Unicode: 你好", "it's WE'LL  don't", "a b  c", "line\r\n\r\n  next", "aaaa aaaaa",
    "<|reserved_0|> is text", "12345 67", "🙂🙂 é ñ", "   ", "tabs\t\tand  spaces ", "",
]


@pytest.fixture(scope="module")
def texts(spark):
    own = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(HAND_MADE)], "doc_id bigint, text string")
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").union(own).cache()


@pytest.fixture(scope="module")
def merges(texts):
    return bpe.train(word_counts(texts, F.col("text")), 60, rounds_per_stage=3)


def test_pretokens_equal_the_pattern(texts):
    form = regex.compile(SPLIT_PATTERN)
    for r in texts.select("text", pretokens(F.col("text")).alias("w")).collect():
        assert list(r.w) == form.findall(r.text)
        assert "".join(r.w) == r.text


def greedy(counts, n):
    words = {w: (list(w.encode()), c) for w, c in counts.items()}
    merges = []
    for k in range(n):
        pairs = Counter()
        for ids, c in words.values():
            for p in zip(ids, ids[1:]):
                pairs[p] += c
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        for w, (ids, c) in words.items():
            out, i = [], 0
            while i < len(ids):
                if tuple(ids[i : i + 2]) == best:
                    out.append(256 + k)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            words[w] = (out, c)
    return merges


def test_training_equals_one_merge_at_a_time(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))): rng.randrange(1, 9) for _ in range(120)}
    counts |= {"aaaaaaa": 40, "aaaa": 7, "bababab": 30, "ééé": 20}
    words = spark.createDataFrame(list(counts.items()), "word string, cnt bigint")
    assert bpe.train(words, 80, rounds_per_stage=5) == greedy(counts, 80)


@pytest.mark.parametrize("seed", range(6))
def test_many_merges_a_round_equal_one_at_a_time(seed):
    """Ties, runs of one letter and overlapping pairs, without the engine: one shard or two."""
    rng = random.Random(seed)
    for _ in range(25):
        letters, most = "abcé"[: rng.randrange(1, 5)], rng.choice([2, 4, 30])
        made = ("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(rng.randrange(1, 80)))
        counts = {w: rng.randrange(1, most) for w in made}
        words, n = list(counts), rng.choice([5, 30, 200])
        half = rng.randrange(len(words))
        shards = [trainer.Shard.of([w.encode() for w in part], [counts[w] for w in part]) for part in (words[:half], words[half:]) if part]
        pairs = trainer.Pairs()
        pairs.add([s.pair_counts() for s in shards])
        while batch := pairs.next_batch(n):
            done = [s.merged(batch) for s in shards]
            shards = [d[0].without_short_words() for d in done]
            pairs.add([d[1:] for d in done])
        assert pairs.merges[:n] == greedy(counts, n)


def test_changes_of_pair_counts_go_to_the_driver_in_few_bytes():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 8_192, 20_000) << 32 | rng.integers(0, 8_192, 20_000))
    for values in (rng.geometric(0.3, len(keys)) * rng.choice([-1, 1], len(keys)), np.full(len(keys), -(2**40))):
        made = trainer.sent(keys, values)
        found = trainer.received(made)
        assert np.array_equal(found[0], keys) and np.array_equal(found[1], values)
        assert sum(map(len, made)) < (keys.nbytes + values.nbytes) / 2
    nothing = np.zeros(0, np.int64)
    assert [len(x) for x in trainer.received(trainer.sent(nothing, nothing))] == [0, 0]


def test_words_shrink_in_their_slots():
    """A merge rewrites the words that it changes and leaves the others where they are."""
    shard = trainer.Shard.of([b"abab", b"xyz", b"ab"], [3, 5, 7])
    after, keys, changes = shard.merged({(97, 98): 256})
    assert after.tokens.tolist() == [257, 257, 0, 0, 0, 121, 122, 123, 0, 257, 0, 0]
    assert dict(zip(keys.tolist(), changes.tolist())) == {97 << 32 | 98: -13, 98 << 32 | 97: -3, 256 << 32 | 256: 3}
    assert after.without_short_words().tokens.tolist() == [257, 257, 0, 121, 122, 123, 0]
    far = after.merged({(256, 256): 70_000})[0]
    assert far.tokens.tolist()[:2] == [70_001, 0] and far.tokens.dtype == np.uint32


def test_the_whole_vocabulary_of_documents(spark, texts):
    """Until 7,932 merges, compared at its end by what the merges do to the words."""
    merges = bpe.train(word_counts(texts, F.col("text")), 7_932)
    counts = Counter(w for r in texts.collect() for w in regex.findall(SPLIT_PATTERN, r.text))
    assert len(merges) == 7_932 == len(set(merges))
    assert merges[:90] == greedy(counts, 90)
    assert all(max(pair) < 256 + i for i, pair in enumerate(merges))


def test_long_words_are_merged_in_little_time():
    rng = random.Random(2)
    counts = {"".join(rng.choices("abcd", k=12)): 1 for _ in range(400)} | {"a" * 40: 9}
    ranks = {pair: i for i, pair in enumerate(greedy(counts, 300))}
    for size in (1, 2, 49, 50, 200, 700):
        for letters in ("a", "ab", "abcd"):
            word = "".join(rng.choices(letters, k=size)).encode()
            ids, short = bpe._merged_by_heap(list(word), ranks), list(word)
            while len(short) > 1:
                best = min(zip(short, short[1:]), key=lambda p: ranks.get(p, 10**9))
                if best not in ranks:
                    break
                out, i = [], 0
                while i < len(short):
                    here = tuple(short[i : i + 2]) == best
                    out.append(256 + ranks[best] if here else short[i])
                    i += 2 if here else 1
                short = out
            assert ids == short
    begun = time.perf_counter()
    assert len(bpe.merged_ids("".join(rng.choices("abcd", k=1_000_000)).encode(), ranks)) < 800_000
    assert time.perf_counter() - begun < 60


def test_decoding_and_lengths_of_odd_lists(spark, merges):
    rows = [(0, None), (1, []), (2, [104, 105]), (3, [-1, 104, 10**6]), (4, [None, 105])]
    df = spark.createDataFrame(rows, "i int, ids array<int>").coalesce(1)
    got = df.select("i", bpe.decoded(F.col("ids"), merges).alias("t"), bpe.bytes_of(F.col("ids"), merges).alias("n")).orderBy("i").collect()
    assert [(r.t, r.n) for r in got] == [(None, None), ("", 0), ("hi", 2), ("h", 1), ("i", 1)]


def test_training_stops_when_no_pair_is_left(spark):
    words = spark.createDataFrame([("ab", 3), ("c", 9)], "word string, cnt bigint")
    assert bpe.train(words, 50) == [(97, 98)]


def test_training_on_documents(texts, merges):
    counts = Counter(w for r in texts.collect() for w in regex.findall(SPLIT_PATTERN, r.text))
    assert merges == greedy(counts, 60)


def test_encoding_equals_public_library(texts, merges):
    ranks = {value: i for i, value in enumerate(bpe.token_values(merges))}
    library = tiktoken.Encoding("check", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = texts.select(
        "text", bpe.encoded(F.col("text"), merges).alias("ids"), bpe.encoded(F.col("text"), merges, 999).alias("with_bos")
    ).collect()
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text)
        assert list(r.with_bos) == [999, *r.ids]


def test_encoding_keeps_nulls_and_small_memory(spark, merges):
    df = spark.createDataFrame([(1, None), (2, "the then"), (3, ""), (4, None)], "id int, text string").coalesce(1)
    ids = bpe.word_encoder(merges, memo_words=1)(pretokens(F.col("text")))
    got = {r.id: r.ids for r in df.select("id", ids.alias("ids")).collect()}
    assert got[1] is None and got[4] is None and list(got[3]) == [] and len(got[2]) > 0


@pytest.mark.parametrize("letters", ["a", "ab", "aab", "abcd"])
def test_many_words_are_encoded_together(letters):
    """In as many passes as a word has merges, not one word after another; runs, empty words and unknown letters included."""
    rng = random.Random(4)
    counts = {"".join(rng.choices("abcd", k=10)): 1 for _ in range(200)} | {"a" * 30: 9}
    ranks = {pair: i for i, pair in enumerate(greedy(counts, 120))}
    words = ["".join(rng.choices(letters + "z" * (i % 2), k=rng.randrange(41))).encode() for i in range(3_000)] + [b""]
    sizes = np.array([len(w) for w in words], np.int64)
    ids, n = bpe.many_merged_ids(np.frombuffer(b"".join(words), np.uint8), sizes, bpe.PairRanks(ranks))
    want = [bpe.merged_ids(w, ranks) for w in words]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_token_counts_leave_a_task_added_up(spark, merges):
    """Short and long words of every partition; a partition returns a row per token, not one per token of each word."""
    rng = random.Random(7)
    counts = {"".join(rng.choices("abe ", k=rng.randrange(1, 90))): rng.randrange(1, 2**40) for _ in range(900)}
    ranks, want = {pair: i for i, pair in enumerate(merges)}, Counter()
    for word, n in counts.items():
        for i in bpe.merged_ids(word.encode(), ranks):
            want[i] += n
    rows = bpe.token_counts(spark.createDataFrame(list(counts.items()), "word string, cnt bigint").repartition(2), merges)
    assert {r.token_id: r.cnt for r in rows.collect()} == want
    assert "Generate explode" not in rows._jdf.queryExecution().toString()
    none = spark.createDataFrame([], "word string, cnt bigint")
    assert bpe.token_counts(none, merges).count() == 0


def test_round_trip(texts, merges):
    rows = texts.select("text", bpe.encoded(F.col("text"), merges).alias("ids"))
    assert rows.filter(bpe.decoded(F.col("ids"), merges) != F.col("text")).count() == 0


def test_decoding_replaces_invalid_bytes(spark, merges):
    df = spark.createDataFrame([([228, 189, 160],), ([200, 65],), ([257 + len(merges)],)], "ids array<int>")
    got = [r.t for r in df.select(bpe.decoded(F.col("ids"), merges).alias("t")).collect()]
    assert got == ["你", "�A", "<|reserved_1|>"]


def test_token_bytes_count_the_decoded_text(spark, merges):
    for r in bpe.vocabulary(spark, merges).collect():
        if r.is_special:
            assert r.n_bytes == r.raw_bytes == 0
        else:
            assert r.n_bytes == len(bytes(r.token).decode("utf-8", "replace").encode())
            assert r.raw_bytes == len(r.token)


def test_token_counts_equal_encoded_documents(texts, merges):
    ids = texts.select(F.explode(bpe.encoded(F.col("text"), merges)).alias("token_id"))
    want = {r.token_id: r["count"] for r in ids.groupBy("token_id").count().collect()}
    got = {r.token_id: r.cnt for r in bpe.token_counts(word_counts(texts, F.col("text")), merges).collect()}
    assert got == want


# --------------------------------------------------------------------------- packing


def naive_pack(batches, capacity, buffer):
    """Linear search over the whole buffer for every placement."""
    held, feed, rows = [], iter(batches), []
    more = True
    while True:
        row = []
        while len(row) < capacity:
            while more and len(held) < buffer:
                batch = next(feed, None)
                if batch is None:
                    more = False
                else:
                    held.extend(batch)
            if not held:
                return rows
            room = capacity - len(row)
            fitting = [d for d in held if len(d) <= room]
            if fitting:
                size = max(map(len, fitting))
                doc = next(d for d in held if len(d) == size)
            else:
                size = min(map(len, held))
                doc = next(d for d in held if len(d) == size)
            held.remove(doc)
            row += doc[:room]
        rows.append(row)


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(9)
    docs = [(s, s * 1000 + i, [7, *[s * 1000 + i] * rng.choice([1, 2, 5, 9, 30, 80])]) for s in range(3) for i in range(rng.randrange(200, 300))]
    return docs, spark.createDataFrame(docs, "shard int, doc_id int, ids array<int>")


def test_packing_equals_naive_search(documents):
    docs, df = documents
    batches = []
    for shard in range(3):
        own = [d[2] for d in docs if d[0] == shard]
        batches += [own[i : i + 128] for i in range(0, len(own), 128)]
    rows = packing.packed(document_batches(df), F.col("ids"), 33, buffer=150, packers=1).orderBy("row_id").collect()
    assert [list(r.tokens) for r in rows] == naive_pack(batches, 33, 150)
    assert all(r.packer_id == 0 for r in rows)


@pytest.mark.parametrize("range_docs", [10_000, 211, 40])
def test_one_loader_cut_into_ranges(documents, range_docs):
    """The rows of one loader, whatever the number of ranges, over two epochs."""
    docs, df = documents
    batches = []
    for shard in range(3):
        own = [d[2] for d in docs if d[0] == shard]
        batches += [own[i : i + 128] for i in range(0, len(own), 128)]
    rows = packing.packed_in_order(document_batches(df, epochs=2), F.col("ids"), 33, buffer=150, range_docs=range_docs)
    rows = rows.orderBy("row_id").collect()
    assert [list(r.tokens) for r in rows] == naive_pack(batches * 2, 33, 150)
    one = packing.packed(document_batches(df, epochs=2), F.col("ids"), 33, buffer=150, packers=1).orderBy("row_id").collect()
    assert rows == one


def test_packing_in_order_of_nothing_and_of_too_little(spark, documents):
    _, df = documents
    assert packing.packed_in_order(document_batches(df.limit(0)), F.col("ids"), 33).collect() == []
    few = spark.createDataFrame([(0, 1, [7, 1]), (0, 2, None), (0, 3, [])], "shard int, doc_id int, ids array<int>").filter("doc_id = 1")
    assert packing.packed_in_order(document_batches(few), F.col("ids"), 33).collect() == []


def test_many_packers_share_a_shard(documents):
    docs, df = documents
    rows = packing.packed(document_batches(df, epochs=2), F.col("ids"), 33, buffer=20, packers=6).cache()
    report = packing.packing_report(rows, 33, 7).head()
    assert report.n_rows == report.full_rows == report.bos_rows > 0
    assert rows.select("packer_id").distinct().count() == 6
    total = 2 * sum(len(d[2]) for d in docs)
    packers = rows.select("packer_id").distinct().count()
    lost = total - 33 * report.n_rows - report.cropped_tokens
    assert 0 <= lost < 33 * (packers + 3) + 81 * 33  # only unfinished last rows


@pytest.mark.parametrize("packers", [1, 3, 5])
def test_packing_ignores_files_and_partitions(spark, documents, tmp_path, packers):
    _, df = documents
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    df.coalesce(1).write.parquet(one)
    df.repartition(5).write.parquet(many)
    key = lambda r: (r.packer_id, r.row_id)
    made = []
    for path, parts in ((one, 1), (many, 7), (many, 2)):
        docs = document_batches(spark.read.parquet(path).repartition(parts), epochs=2)
        rows = packing.packed(docs, F.col("ids"), 33, buffer=20, packers=packers).collect()
        made.append([(key(r), list(r.tokens), r.epoch, r.drain) for r in sorted(rows, key=key)])
    assert made[0] == made[1] == made[2]


def test_each_packer_is_a_loader_of_its_range(documents):
    docs, df = documents
    batches = []
    for shard in range(3):
        own = [d[2] for d in docs if d[0] == shard]
        batches += [own[i : i + 128] for i in range(0, len(own), 128)]
    rows = packing.packed(document_batches(df), F.col("ids"), 33, buffer=20, packers=2).orderBy("packer_id", "row_id").collect()
    for packer in (0, 1):
        mine = [b for i, b in enumerate(batches) if i * 2 // len(batches) == packer]
        assert [list(r.tokens) for r in rows if r.packer_id == packer] == naive_pack(mine, 33, 20)


def test_evaluation_rows(documents):
    rows = packing.packed(document_batches(documents[1]), F.col("ids"), 33, buffer=20, packers=6)
    assert packing.evaluation_rows(rows, 4, 32 * 25, 32).count() == 24


def test_texts_are_encoded_before_they_are_put_in_order(spark, monkeypatch):
    """Few shards make few tasks of an order, so what is ordered for packing holds token ids and no text."""
    from tidemark.queries import tokens as queries

    given = []
    real = packing.packed_in_order
    monkeypatch.setattr(queries, "merges", lambda *_: [(97, 98)])
    monkeypatch.setattr(queries.sinks, "built_once", lambda spark, path, build: build())
    monkeypatch.setattr(packing, "packed_in_order", lambda docs, *rest: given.append(docs) or real(docs, *rest))
    rows = queries.packed_rows(spark, SMALL, "train")
    assert "text" not in given[0].columns and "ids" in given[0].columns
    assert rows.count() and rows.filter(F.size("tokens") != queries.ROW_TOKENS).count() == 0
