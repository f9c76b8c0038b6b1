"""Language-model scoring by a hierarchical Pitman-Yor model.

Every word is a context with a restaurant of its own, where the tokens that follow it are seated; all of these restaurants
share one parent, and a new table sends a customer there; the parent's parent is uniform over the known words and one
class of unknown ones. Seatings are sampled by Gibbs: customers leave their tables and take seats anew, at a table in
proportion to its size less the discount, or at a new one in proportion to the parent's probability of the word. Only the
numbers of tables matter, so a sweep draws, for every pair, that of all its customers seated anew (``table_counts``). A
text is scored with predictive probabilities averaged over several samples.

How this is divided: documents are read as blocks of tokens. A block sends its words, and later its (context, word)
pairs, to buckets by key and gets the answers back in the order that it sent the keys in, so neither the vocabulary nor
the pairs ever meet in one place. Pairs are in buckets by context, and those of a very frequent context are divided by
word as well. What the pairs of a restaurant share is its total of tables, T. Given a draw g of Gamma(concentration/discount + T)
for it they are independent, and discount * g * (parent's probability) weighs a pair's new table: so one sweep takes all pairs of a
bucket at once. A restaurant in several buckets counts its tables elsewhere as the round before left them, in the first round and
in the parent as many as its own in each. Between rounds, the buckets' tables are summed by word, where the parent's seating is sampled, and its probabilities go
back. Discounts come from the counts of counts.

Words are told apart by 64-bit hashes. Every draw is seeded by its bucket, so reruns agree.

Defined cases: a null text is empty: one end token; the end token is also the context of the first word; without training
documents every known count is zero, and a token's probability is one, there being one class of words; repeated rows
and null ids (in the held-out tenth) count like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.exchange import array, ascending, distinct, divided, packed, per_group, per_row, stage_arrays
from tidemark.llm.registry import query, table
from tidemark.llm.table_counts import TableCounts

BLOCK_TOKENS = 3_000_000
#: Tokens (of all blocks) for each bucket of words and of pairs.
WORD_BUCKET_TOKENS, PAIR_BUCKET_TOKENS = 4_000_000, 2_000_000
#: A context is divided among the buckets when it holds more than this share of one.
HOT_SHARE = 0.25
CONCENTRATION = (1.0, 3.0)
#: Sweeps before the first sample, between samples, and samples of the last round.
BURN_IN, BETWEEN, SAMPLES = 10, 4, 3
END = b""


# --------------------------------------------------------------------------- blocks and their words

BLOCK = "docs bigint, held binary, lengths binary, tokens binary, hashes binary, routes binary, counts binary"


def _route(hashes: np.ndarray) -> np.ndarray:
    """The bits of a word's hash that choose its bucket."""
    return (hashes >> np.uint64(40)).astype(np.int64)


def _words(texts: pa.Array) -> pa.ListArray:
    """The words of each text in lower case, and the end token."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # What splits at the last space leaves an empty string behind it, as an empty text is one.
    closed = pc.if_else(pc.equal(pc.binary_length(trimmed), 0), trimmed, pc.binary_join_element_wise(trimmed, "", " "))
    return pc.ascii_split_whitespace(closed)


def _each(words: pa.LargeBinaryArray) -> Iterator[bytes]:
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    data = data.to_pybytes()
    return (data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()))


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Blocks of tokens, numbered within each, with their words' hashes and training counts; and the blocks' doc_ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, lengths, tokens = [], [], [], []
        seen = 0

        def block() -> pa.RecordBatch:
            coded = pa.chunked_array([pa.array([END], pa.large_binary()), *tokens]).dictionary_encode().chunks
            hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, _each(coded[-1].dictionary)), np.uint64)
            line = np.concatenate([c.indices.to_numpy() for c in coded[1:]])
            out, length = np.concatenate(held), np.concatenate(lengths)
            counts = np.bincount(line[np.repeat(~out, length)], minlength=len(hashed))
            routes = _route(hashed)
            row = [len(length), *map(packed, (out.astype(np.int64), length, line, hashed, routes, counts))]
            every = pa.ListArray.from_arrays([0, len(length)], pa.concat_arrays(ids))
            return pa.record_batch([every, *(pa.array([v]) for v in row)], names=names)

        for batch in batches:
            words = _words(batch.column(1))
            ends = words.offsets.to_numpy()
            first = 0
            while first < batch.num_rows:
                last = min(int(np.searchsorted(ends, ends[first] + block_tokens - seen)), batch.num_rows)
                ids.append(batch.column(0)[first:last].cast(kind))
                held.append(batch.column(2)[first:last].to_numpy(zero_copy_only=False))
                lengths.append(np.diff(ends[first : last + 1]))
                tokens.append(words.values[ends[first] : ends[last]].cast(pa.large_binary()))
                seen += int(ends[last] - ends[first])
                if seen >= block_tokens:
                    yield block()
                    seen = 0
                    ids, held, lengths, tokens = [], [], [], []
                first = last
        if ids:
            yield block()

    import pyspark.sql.pandas.types as arrow

    kind = arrow.to_arrow_type(docs.schema["doc_id"].dataType)
    names = ["ids", "docs", "held", "lengths", "tokens", "hashes", "routes", "counts"]
    schema = f"ids array<{docs.schema['doc_id'].dataType.simpleString()}>, " + BLOCK
    out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 10 == 0
    rows = docs.select("doc_id", "text", out.alias("out")).mapInArrow(read, schema)
    rows = stage_arrays(rows.withColumn("block", F.monotonically_increasing_id()), "blocks")
    return rows.drop("ids"), rows.select("block", "ids")


# --------------------------------------------------------------------------- seating


class Seating:
    """Customers of many dishes at tables; a dish has ``c`` customers, and ``weight`` is that of a new table.

    One customer after the other, as the sampler is defined; ``TableCounts`` draws for all of them, and is compared with it.
    """

    def __init__(self, c: np.ndarray, weight: np.ndarray, discount: float, seed: int) -> None:
        self.c, self.discount, self.random = c, discount, np.random.default_rng(seed)
        # The first seating is arbitrary: about as many tables as expected, each half as large as the one before.
        expected = weight * np.log1p(c / np.maximum(weight, 1e-12))
        tables = np.clip(np.rint(expected), 1, np.maximum(c // 2, 1)).astype(np.int64)
        tables[c <= 16] = 1
        self.dish = np.repeat(np.arange(len(c)), tables)
        nth = np.arange(len(self.dish)) - np.repeat(np.cumsum(tables) - tables, tables)
        spare = (c - tables)[self.dish]
        self.size = 1 + np.where(nth == 0, 0, (spare * 0.5 ** np.minimum(nth, 60)).astype(np.int64))
        used = np.bincount(self.dish, self.size, len(c)).astype(np.int64)
        self.size[nth == 0] += c - used

    @property
    def tables(self) -> np.ndarray:
        return np.bincount(self.dish, minlength=len(self.c))

    def move(self, weight: np.ndarray) -> None:
        """One customer of every dish leaves its table and is seated anew."""
        c, size, dish = self.c, self.size, self.dish
        if not len(c):
            return
        ends = np.cumsum(size)
        before = np.concatenate([[0], np.cumsum(c)[:-1]])
        left = np.searchsorted(ends, before + np.floor(self.random.random(len(c)) * c).astype(np.int64), "right")
        size[left] -= 1
        mass = np.where(size > 0, size - self.discount, 0.0)
        ends = np.cumsum(mass)
        first = np.concatenate([[0], np.flatnonzero(np.diff(dish)) + 1])
        last = np.concatenate([first[1:], [len(dish)]]) - 1
        start = ends[first] - mass[first]
        total = np.maximum(ends[last] - start, 0)
        drawn = self.random.random(len(c)) * (total + weight)
        old = (drawn < total) & (total > 1e-9)
        seat = np.clip(np.searchsorted(ends, start + drawn, "right"), first, last)
        old &= mass[seat] > 0
        size[seat[old]] += 1
        new = np.flatnonzero(~old)
        keep = size > 0
        dish = np.concatenate([dish[keep], new])
        order = np.argsort(dish, kind="stable")
        self.dish, self.size = dish[order], np.concatenate([size[keep], np.ones(len(new), size.dtype)])[order]


def sampled_tables(
    context: np.ndarray,
    c: np.ndarray,
    parent: np.ndarray,
    spread: np.ndarray,
    discount: float,
    concentration: float,
    seed: int,
    samples: int,
    elsewhere: np.ndarray | None = None,
) -> list[np.ndarray]:
    """Tables of each (context, dish) in each sample; a sweep seats every customer anew.

    ``spread``: how many buckets share each context's restaurant; ``elsewhere``: its tables in the other ones, where known.
    """
    several = np.flatnonzero(c > 1)
    tables = np.minimum(c, 1)
    own, alone = parent[several], np.bincount(context, tables, len(spread))
    shared, at = distinct(context[several])  # only these contexts have weights to be drawn
    alone, spread = (alone - np.bincount(context[several], minlength=len(spread)))[shared], spread[shared]
    elsewhere = None if elsewhere is None else elsewhere[shared]
    random = np.random.default_rng([seed, 1])

    def weight() -> np.ndarray:
        total = alone + np.bincount(at, seated.tables, len(shared))
        total = total * spread if elsewhere is None else total + elsewhere
        return discount * random.gamma(concentration / discount + total)[at] * own

    seated = TableCounts(c[several], discount, seed)
    seated.begin(weight())
    out = []
    for n in range(1, BURN_IN + BETWEEN * (samples - 1) + 1):
        seated.draw(weight())
        if n >= BURN_IN and (n - BURN_IN) % BETWEEN == 0:
            now = tables.copy()
            now[several] = seated.tables
            out.append(now)
    return out


def discount_of(once: int, twice: int) -> float:
    """From how many keys occur once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


# --------------------------------------------------------------------------- the model


def _word_totals(found: DataFrame, buckets: int) -> DataFrame:
    """For each block and word bucket: the words' numbers and training counts, in the order of the block's hashes."""

    def send(row: dict):
        hashes, counts = array(row["hashes"], "u8"), array(row["counts"])
        for bucket, at in divided(_route(hashes), buckets):
            yield bucket, row["block"], packed(hashes[at]), packed(counts[at])

    def total(bucket: int, rows: list[dict]):
        hashes = [array(r["hashes"], "u8") for r in rows]
        every, place = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(place, np.concatenate([array(r["counts"]) for r in rows])).astype(np.int64)
        rank = np.empty(len(every), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(every))
        numbers = (rank * buckets + bucket)[place]  # a word's number tells its bucket; frequent words have small ones
        at = 0
        for row, own in zip(rows, hashes):
            part = slice(at, at + len(own))
            at += len(own)
            yield bucket, row["block"], packed(numbers[part]), packed(counts[place[part]]), 0, 0, 0
        known = counts > 0
        yield bucket, None, packed(np.arange(0)), packed(counts), int(counts.sum()), int(known.sum()), len(every)

    sent = per_row(found.select("block", "hashes", "counts"), send, "bucket bigint, block bigint, hashes binary, counts binary")
    schema = "bucket bigint, block bigint, numbers binary, counts binary, tokens bigint, known bigint, words bigint"
    return stage_arrays(per_group(sent, "bucket", total, schema), "words")


def _aligned(routes: np.ndarray, buckets: int, answers: dict[int, tuple]) -> list[np.ndarray]:
    """The answers of all buckets, put in the order of the words."""
    out = None
    for bucket, at in divided(routes, buckets):
        if out is None:
            out = [np.zeros(len(routes), a.dtype) for a in answers[bucket]]
        for whole, part in zip(out, answers[bucket]):
            whole[at] = part
    return out


def _pairs(row: dict, answers: list[dict], buckets: int) -> tuple:
    """Of a block: numbers and counts of its words, and (context, word) of its tokens as places among its words."""
    parts = {a["bucket"]: (array(a["numbers"]), array(a["counts"])) for a in answers}
    numbers, counts = _aligned(array(row["routes"]), buckets, parts)
    order = np.argsort(numbers)  # pairs are sent in the order of the words' numbers
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    tokens, lengths = place[array(row["tokens"])], array(row["lengths"])
    contexts = np.concatenate([place[:1], tokens[:-1]])
    contexts[np.cumsum(lengths)[:-1]] = place[0]  # the end token, the first word of every block
    key, which = distinct(contexts * len(order) + tokens)
    train = np.repeat(~array(row["held"], bool), lengths)
    seen = np.bincount(which[train], minlength=len(key))
    return numbers, counts, order[key // len(order)], order[key % len(order)], which, seen


def _coarse(counts: np.ndarray) -> np.ndarray:
    """Counts to within a few percent, in a byte: they only set the first round's parent."""
    return np.rint(8 * np.log2(counts + 1.0)).astype(np.int64)


def _fine(coarse: np.ndarray) -> np.ndarray:
    return np.maximum(2.0 ** (coarse / 8) - 1, 0.1)


def _pair_buckets(numbers, counts, context, word, buckets: int, tokens: int) -> np.ndarray:
    hot = counts[context] > HOT_SHARE * tokens / buckets
    return numbers[context] + np.where(hot, numbers[word] // 3 + numbers[word], 0)


def scored(
    docs: DataFrame,
    block_tokens: int = BLOCK_TOKENS,
    word_bucket_tokens: int = WORD_BUCKET_TOKENS,
    pair_bucket_tokens: int = PAIR_BUCKET_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    spark = docs.sparkSession
    rows, names = blocks(docs, block_tokens)
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = rows.agg(F.sum("docs"), F.sum(F.octet_length("tokens"))).first()
    if not size[0]:
        return spark.createDataFrame(
            [], f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
        )
    volume = int(size[1])  # about one byte a token
    word_buckets = -(-volume // word_bucket_tokens) + 3
    pair_buckets = -(-volume // pair_bucket_tokens) + 3

    words = _word_totals(rows, word_buckets)
    totals = words.filter("block IS NULL")
    tokens, known = totals.agg(F.sum("tokens"), F.sum("known")).first()
    replies = words.filter("block IS NOT NULL")

    # --- pairs to their buckets
    def both(block: int, group: list[dict]):
        own = next(r for r in group if r["tokens_"] is not None)
        row = {"routes": own["routes"], "tokens": own["tokens_"], "lengths": own["lengths"], "held": own["held"]}
        return row, [r for r in group if r["tokens_"] is None]

    empty = [F.lit(None).cast("binary").alias(c) for c in ("routes", "tokens_", "lengths", "held")]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("bucket", "bigint"), ("numbers", "binary"), ("counts", "binary"))]
    own = rows.select("block", "routes", F.col("tokens").alias("tokens_"), "lengths", "held", *none)
    with_words = own.unionByName(replies.select("block", *empty, "bucket", "numbers", "counts"))

    def send_pairs(block: int, group: list[dict]):
        row, answers = both(block, group)
        numbers, counts, context, word, _, seen = _pairs(row, answers, word_buckets)
        key = _pair_buckets(numbers, counts, context, word, pair_buckets, tokens)
        for bucket, at in divided(key, pair_buckets):
            yield bucket, block, packed(numbers[context[at]]), packed(numbers[word[at]]), packed(counts[context[at]]), packed(_coarse(counts[word[at]])), packed(seen[at])

    schema = "bucket bigint, block bigint, context binary, word binary, c_context binary, c_word binary, seen binary"
    sent = per_group(with_words, "block", send_pairs, schema)

    def merge(bucket: int, group: list[dict]):
        """The distinct pairs of a bucket, and for each block where its pairs are among them."""
        context, word, c_context, c_word, seen = (
            np.concatenate([array(r[c]) for r in group]) for c in ("context", "word", "c_context", "c_word", "seen")
        )
        left, (words, right) = distinct(context)[1], distinct(word)
        key, place = distinct(left * len(words) + right)
        total = np.bincount(place, seen).astype(np.int64)
        one = np.empty(len(key), np.int64)
        one[place] = np.arange(len(place))  # counts of a word are the same in all blocks
        real = total > 0
        rank, there = np.cumsum(real)[place], real[place]  # the pair's place among those of training documents, from 1
        at = 0
        for row in group:
            n = len(array(row["seen"], "u1"))
            yield bucket, row["block"], ascending(rank[at : at + n]), packed(there[at : at + n].astype(np.int64)), *[None] * 5, 0, 0
            at += n
        one = one[real]
        values = (context[one], word[one], c_context[one], c_word[one], total[real])
        yield bucket, None, None, None, *map(packed, values), int((total == 1).sum()), int((total == 2).sum())

    schema = "bucket bigint, block bigint, position binary, there binary, context binary, word binary, c_context binary, c_word binary, c binary, once bigint, twice bigint"
    pairs = stage_arrays(per_group(sent, "bucket", merge, schema), "pairs")
    types = pairs.filter("block IS NULL")
    once, twice = types.agg(F.sum("once"), F.sum("twice")).first()
    discount, concentration = discount_of(once or 0, twice or 0), CONCENTRATION[1]

    def seat(row: dict, parent: np.ndarray, dishes: np.ndarray, dish: np.ndarray, samples: int, seed: int, elsewhere=None):
        """Tables by pair, and their sums by word (as dish) and by context, for each sample."""
        context, c, c_context = (array(row[n]) for n in ("context", "c", "c_context"))
        every, at = distinct(context)
        hot = np.zeros(len(every), np.int64)
        hot[at] = c_context
        spread = np.where(hot > HOT_SHARE * tokens / pair_buckets, pair_buckets, 1)
        others = None if elsewhere is None else elsewhere(every)
        found = sampled_tables(at, c, parent[dish], spread, discount, concentration, seed + row["bucket"], samples, others)
        as_dish = [np.bincount(dish, t, len(dishes)).astype(np.int64) for t in found]
        as_context = [np.bincount(at, t, len(every)).astype(np.int64) for t in found]
        return found, every, as_dish, as_context

    def send_tables(bucket, dishes, as_dish, every, as_context):
        numbers = np.union1d(dishes, every)
        rows_of = lambda keys, values: np.stack([_spread(numbers, keys, v) for v in values])
        a, b = rows_of(dishes, as_dish), rows_of(every, as_context)
        for to, at in divided(numbers, word_buckets):
            yield to, bucket, ascending(numbers[at]), packed(a[:, at].ravel()), packed(b[:, at].ravel())

    # --- first round: the parent is the words' own shares
    def first_round(row: dict):
        if row["c"] is None:
            return
        dishes, dish = distinct(array(row["word"]))
        parent = np.zeros(len(dishes))
        parent[dish] = _fine(array(row["c_word"])) / tokens
        _, every, as_dish, as_context = seat(row, parent, dishes, dish, 1, 1_000_003)
        yield from send_tables(row["bucket"], dishes, as_dish, every, as_context)

    tables = "to bigint, bucket bigint, numbers binary, dish binary, context binary"
    round_one = _parents(per_row(types, first_round, tables), word_buckets, 1, known)

    # --- last round: seatings under the sampled parent
    def last_round(bucket: int, group: list[dict]):
        row = next(r for r in group if r["c"] is not None)
        dishes, dish = distinct(array(row["word"]))
        numbers, values, others = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
        for r in group:
            if r["c"] is None:
                numbers.append(np.cumsum(array(r["numbers"])))
                values.append(array(r["parent"], "f8"))
                others.append(array(r["elsewhere"]))
        numbers, values, others = np.concatenate(numbers), np.concatenate(values), np.concatenate(others)
        order = np.argsort(numbers)
        parent = values[order][np.searchsorted(numbers[order], dishes)]
        elsewhere = lambda contexts: others[order][np.searchsorted(numbers[order], contexts)]
        found, every, as_dish, as_context = seat(row, parent, dishes, dish, SAMPLES, 2_000_003, elsewhere)
        mean = np.mean(found, axis=0)
        kept = (array(row["c"]) - discount * mean).astype(np.float32)
        yield bucket, None, None, None, None, packed(kept)
        for to, _, n, a, b in send_tables(bucket, dishes, as_dish, every, as_context):
            yield bucket, to, n, a, b, None

    columns = ("bucket", "context", "word", "c_context", "c")
    static = types.filter("octet_length(c) > 0").select(*columns, *[F.lit(None).cast("binary").alias(n) for n in ("numbers", "parent", "elsewhere")])
    answers = round_one.filter("bucket IS NOT NULL").select(
        "bucket", *[F.lit(None).cast("binary").alias(n) for n in columns[1:]], "numbers", "parent", F.col("context").alias("elsewhere")
    )
    schema = "bucket bigint, to bigint, numbers binary, dish binary, context binary, kept binary"
    seated = stage_arrays(per_group(static.unionByName(answers), "bucket", last_round, schema), "seated")
    parents = _parents(seated.filter("to IS NOT NULL").select("to", "bucket", "numbers", "dish", "context"), word_buckets, SAMPLES, known, replies)

    # --- answers to the blocks
    def keep(bucket: int, group: list[dict]):
        kept = next((array(r["kept"], "f4") for r in group if r["kept"] is not None), np.zeros(0, np.float32))
        kept = np.concatenate([np.zeros(1, np.float32), kept])
        for r in group:
            if r["position"] is not None:
                yield bucket, r["block"], packed(kept[np.cumsum(array(r["position"])) * array(r["there"])])

    asked = pairs.filter("block IS NOT NULL").select("bucket", "block", "position", "there", F.lit(None).cast("binary").alias("kept"))
    known_pairs = seated.filter("to IS NULL").select("bucket", F.lit(None).cast("bigint").alias("block"), *[F.lit(None).cast("binary").alias(c) for c in ("position", "there")], "kept")
    kept_rows = per_group(asked.unionByName(known_pairs), "bucket", keep, "bucket bigint, block bigint, kept binary")

    def finish(block: int, group: list[dict]):
        row, rest = both(block, group)
        numbers, counts, context, word, place, _ = _pairs(row, [r for r in rest if r["numbers"] is not None], word_buckets)
        key = _pair_buckets(numbers, counts, context, word, pair_buckets, tokens)
        kept = np.zeros(len(key))
        by_bucket = {r["bucket"]: r["kept"] for r in rest if r["kept"] is not None}
        for bucket, at in divided(key, pair_buckets):
            kept[at] = array(by_bucket[bucket], "f8")
        home = array(row["routes"]) % word_buckets
        backed = np.zeros((SAMPLES, len(home)))
        parent = np.zeros((SAMPLES, len(home)))
        for r in rest:
            if r["parent"] is not None:
                at = np.flatnonzero(home == int(r["bucket"]))
                parent[:, at] = array(r["parent"], "f8").reshape(SAMPLES, -1)
                backed[:, at] = array(r["context"], "f8").reshape(SAMPLES, -1)
        docs_of = array(row["lengths"])
        visits = counts[context].astype(float)  # a word is a context as often as it occurs; so is the end
        new = (concentration + discount * backed[:, context]) * parent[:, word]
        probability = (kept + new.mean(axis=0)) / (concentration + visits)
        log = np.log10(probability)[place]
        base = np.log10((counts + 0.1) / (tokens + 0.1 * (known + 1)))[array(row["tokens"])]
        seen = (counts > 0)[array(row["tokens"])]
        first = np.cumsum(docs_of) - docs_of
        per_doc = lambda v: np.add.reduceat(v, first)
        held = array(row["held"], bool)
        yield block, held.tolist(), docs_of.tolist(), per_doc(seen.astype(np.int64)).tolist(), per_doc(base).tolist(), per_doc(log).tolist()

    more = ("kept", "parent", "context")
    blank = lambda *n: [F.lit(None).cast("binary").alias(c) for c in n]
    everything = (
        with_words.select("*", *blank(*more))
        .unionByName(kept_rows.select("bucket", "block", "kept", *blank("routes", "tokens_", "lengths", "held", "numbers", "counts", "parent", "context")))
        .unionByName(parents.filter("block IS NOT NULL").select(F.col("to").alias("bucket"), "block", "parent", "context", *blank("routes", "tokens_", "lengths", "held", "numbers", "counts", "kept")))
    )
    schema = "block bigint, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base_score array<double>, score array<double>"
    results = per_group(everything, "block", finish, schema).join(names, "block")
    columns = ("ids", "held_out", "n_tokens", "n_known", "base_score", "score")
    each = results.select(F.explode(F.arrays_zip(*columns)).alias("d")).select("d.*")
    return each.select(
        F.col("ids").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def _spread(every: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(every), np.int64)
    out[np.searchsorted(every, keys)] = values
    return out


def _parents(sent: DataFrame, buckets: int, samples: int, known: int, asking: DataFrame | None = None) -> DataFrame:
    """The parent's probabilities, sampled in buckets of words from the tables that the restaurants sent.

    Answers go to the buckets that sent, or, given the ``asking`` blocks with the numbers of their words, to those. With them go
    the tables of each word's own restaurant: to buckets those that others have sent, to blocks all.
    """

    def sums(rows: list[dict]):
        numbers = np.concatenate([np.cumsum(array(r["numbers"])) for r in rows])
        every, place = distinct(numbers)
        parts = lambda c: np.concatenate([array(r[c]).reshape(samples, -1) for r in rows], axis=1)
        add = lambda v: np.stack([np.bincount(place, s, len(every)).astype(np.int64) for s in v])
        return every, add(parts("dish")), add(parts("context"))

    def seat(to: int, rows: list[dict]):
        every, dish, context = sums(rows)
        once, twice = int((dish == 1).sum()), int((dish == 2).sum())
        discount = discount_of(once, twice)
        seated = []
        for s, customers in enumerate(dish):
            one = np.zeros(len(customers), np.int64)
            uniform = np.full(len(customers), 1 / (known + 1))
            seated.append(sampled_tables(one, customers, uniform, np.array([buckets]), discount, CONCENTRATION[0], 3_000_017 * (s + 1) + to, 1)[-1])
        seated = np.stack(seated) if seated else np.zeros_like(dish)
        yield to, packed(every), packed((dish - discount * seated).astype(np.float64).ravel()), packed(context.ravel()), dish.sum(axis=1).tolist(), (discount * seated.sum(axis=1)).tolist()

    schema = "to bigint, numbers binary, kept binary, context binary, customers array<bigint>, discounted array<double>"
    sent = stage_arrays(sent, "tables")
    words = stage_arrays(per_group(sent, "to", seat, schema), "parent")
    picked = [F.sum(F.col(c)[s]) for c in ("customers", "discounted") for s in range(samples)]
    sums_ = [float(v or 0) for v in words.agg(*picked).first()]
    customers, discounted = np.array(sums_[:samples]), np.array(sums_[samples:])
    uniform = (CONCENTRATION[0] + discounted) / (CONCENTRATION[0] + customers) / (known + 1)

    to_buckets = asking is None

    def answer(to: int, group: list[dict]):
        row = next((r for r in group if r["kept"] is not None), None)
        every = array(row["numbers"]) if row else np.zeros(0, np.int64)
        kept = array(row["kept"], "f8").reshape(samples, -1) if row else np.zeros((samples, 0))
        context = array(row["context"]).reshape(samples, -1) if row else np.zeros((samples, 0), np.int64)
        parent = kept / (CONCENTRATION[0] + customers)[:, None] + uniform[:, None]
        for r in group:
            if r["kept"] is not None:
                continue
            wanted = np.cumsum(array(r["numbers"])) if to_buckets else array(r["numbers"])
            at = np.minimum(np.searchsorted(every, wanted), max(0, len(every) - 1))
            there = (every[at] == wanted) if len(every) else np.zeros(len(wanted), bool)
            p = np.where(there, parent[:, at], uniform[:, None]) if len(every) else np.repeat(uniform[:, None], len(wanted), 1)
            t = np.where(there, context[:, at], 0) if len(every) else np.zeros((samples, len(wanted)), np.int64)
            t = t - array(r["own"]).reshape(samples, -1) if to_buckets else t
            yield to, r["bucket"], r["block"], r["numbers"] if to_buckets else None, packed(p.ravel().astype(np.float32)), packed(t.ravel())

    blank = lambda *n: [F.lit(None).cast(t).alias(c) for c, t in n]
    own = words.select("to", "numbers", "kept", "context", *blank(("bucket", "bigint"), ("block", "bigint"), ("own", "binary")))
    if asking is None:
        asked = sent.select("to", "numbers", *blank(("kept", "binary"), ("context", "binary"), ("block", "bigint")), "bucket", F.col("context").alias("own"))
    else:
        asked = asking.select(F.col("bucket").alias("to"), "numbers", "block", *blank(("kept", "binary"), ("context", "binary"), ("bucket", "bigint"), ("own", "binary")))
    schema = "to bigint, bucket bigint, block bigint, numbers binary, parent binary, context binary"
    return per_group(own.unionByName(asked), "to", answer, schema)


@query("op1_pitman_yor")
def pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model of the documents outside the held-out tenth."""
    return scored(table(spark, folder, "documents"))
