"""Byte-pair vocabulary: pair counts, the token table, encoding and decoding. Training is in ``merges``."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.tokens import SPECIAL_TOKENS, pretokens
from tidemark.operators.merges import FIRST_MERGED, Merge, apart, train

__all__ = ["FIRST_MERGED", "Merge", "train"]

#: Longer words are merged with a heap; in short ones all pairs are looked at again after each merge, in many words at once.
HEAP_TOKENS = 48
#: Long words whose ids a task remembers.
MEMO_WORDS = 10_000
#: Words that are encoded together where they are rows.
WORDS_AT_ONCE = 50_000


def as_symbols(word: Column) -> Column:
    """The UTF-8 bytes of a word as characters of Latin-1, one for each."""
    return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")


# --------------------------------------------------------------------------- training


def pair_counts(symbols: DataFrame) -> DataFrame:
    """How often each two neighbouring tokens occur, over all words (symbols, cnt)."""
    pairs = F.regexp_extract_all("symbols", F.lit("(?s)(?=(..))"), F.lit(1))
    return symbols.select(F.explode(pairs).alias("pair"), "cnt").groupBy("pair").agg(F.sum("cnt").alias("cnt"))


# --------------------------------------------------------------------------- vocabulary


def token_values(merges: Sequence[Merge]) -> list[bytes]:
    values = [bytes([b]) for b in range(FIRST_MERGED)]
    for left, right in merges:
        values.append(values[left] + values[right])
    return values


def vocabulary(spark: SparkSession, merges: Sequence[Merge], special: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """The token table: bytes, merged tokens by rank, then the special tokens.

    ``n_bytes`` is the UTF-8 length of the token decoded by itself, so bytes that are not valid UTF-8 alone count as
    the replacement character; special tokens have none. ``raw_bytes`` is the plain length.
    """
    values = token_values(merges)
    rows = [(i, v, False, *(merges[i - FIRST_MERGED] if i >= FIRST_MERGED else (None, None))) for i, v in enumerate(values)]
    rows += [(len(values) + i, name.encode(), True, None, None) for i, name in enumerate(special)]
    table = spark.createDataFrame(
        rows, "token_id int, token binary, is_special boolean, left_id int, right_id int"
    )
    shown = F.octet_length(F.make_valid_utf8(F.col("token").cast("string")))
    return table.withColumns(
        {
            "n_bytes": F.when(F.col("is_special"), 0).otherwise(shown),
            "raw_bytes": F.when(F.col("is_special"), 0).otherwise(F.octet_length("token")),
        }
    )


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Number of tokens and the id that begins a document."""
    bos = F.min(F.when(F.col("is_special"), F.col("token_id")))
    return vocab.agg((F.max("token_id") + 1).alias("n_vocab"), bos.alias("bos_id"))


def bos_id(merges: Sequence[Merge]) -> int:
    return FIRST_MERGED + len(merges)


# --------------------------------------------------------------------------- encoding and decoding


def merged_ids(word: bytes, ranks: Mapping[Merge, int]) -> list[int]:
    """Token ids of a word: the pair of the lowest rank is merged wherever it is, from the left, until none has a rank."""
    found = list(word)
    if len(found) > HEAP_TOKENS:
        return _merged_by_heap(found, ranks)
    unknown = len(ranks)
    while len(found) > 1:
        pairs = list(zip(found, found[1:]))
        known = [ranks.get(p, unknown) for p in pairs]
        rank = min(known)
        if rank == unknown:
            break
        pair, at, merged = pairs[known.index(rank)], 0, []
        while at < len(found):
            here = at < len(pairs) and pairs[at] == pair
            merged.append(FIRST_MERGED + rank if here else found[at])
            at += 2 if here else 1
        found = merged
    return found


def _merged_by_heap(ids: list[int], ranks: Mapping[Merge, int]) -> list[int]:
    """The same in a time that grows little faster than the word: neighbours are linked, pairs wait in a heap."""
    count, gone = len(ids), -1
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))
    heap = [(ranks[pair], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
    heapq.heapify(heap)
    while heap:
        rank, left, pair = heapq.heappop(heap)
        right = after[left]
        if ids[left] == gone or right == count or (ids[left], ids[right]) != pair:
            continue  # a neighbour has been merged meanwhile
        ids[left], ids[right] = FIRST_MERGED + rank, gone
        after[left] = after[right]
        if after[right] < count:
            before[after[right]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b < count and (made := (ids[a], ids[b])) in ranks:
                heapq.heappush(heap, (ranks[made], a, made))
    return [i for i in ids if i != gone]


class PairRanks:
    """Ranks of pairs, for whole arrays of them."""

    def __init__(self, ranks: Mapping[Merge, int]) -> None:
        pairs = np.array(list(ranks), np.int64).reshape(-1, 2)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        #: The rank of a pair that is not merged; a last key that is none stands for all of these.
        self.unknown = len(ranks)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.fromiter(ranks.values(), np.int64, len(ranks))[order], self.unknown).astype(np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        place = np.searchsorted(self.keys, keys)
        return np.where(self.keys[place] == keys, self.ranks[place], np.int32(self.unknown))


def many_merged_ids(data: np.ndarray, sizes: np.ndarray, ranks: PairRanks) -> tuple[np.ndarray, np.ndarray]:
    """``merged_ids`` of many words, given as their bytes in a row and the bytes of each: all ids in a row, and how many each has.

    A pass merges in every word its own pair of the lowest rank, so there are as many passes as a word has merges; words that
    are done are left out of the next.
    """
    begins = np.cumsum(sizes) - sizes
    ids, counts = data.astype(np.int32), np.zeros(len(sizes), np.int64)
    words = np.flatnonzero(sizes)  # those that are not done, their tokens, how many each has, and the ranks of pairs by the left one
    left, tokens = sizes[words], ids.copy()
    rank = np.full(len(tokens), ranks.unknown, np.int32)
    rank[:-1] = ranks.of(tokens[:-1], tokens[1:])
    rank[np.cumsum(left) - 1] = ranks.unknown
    while len(words):
        best = np.minimum.reduceat(rank, np.cumsum(left) - left)
        more = best < ranks.unknown
        stay = np.repeat(more, left)
        done, n = words[~more], left[~more]
        ids[np.repeat(begins[done] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = tokens[~stay]
        counts[done] = n
        words, left, best, tokens, rank = words[more], left[more], best[more], tokens[stay], rank[stay]
        at = apart(np.flatnonzero(rank == np.repeat(best, left)), tokens)
        if not len(at):
            break
        tokens[at] = FIRST_MERGED + rank[at]
        keep = np.ones(len(tokens), bool)
        keep[at + 1] = False
        left = left - np.add.reduceat(~keep, np.cumsum(left) - left, dtype=np.int64)
        tokens, rank, at = tokens[keep], rank[keep], at - np.arange(len(at))
        changed = np.concatenate([at, at[at > 0] - 1])
        rank[changed] = ranks.of(tokens[changed], tokens[np.minimum(changed + 1, len(tokens) - 1)])
        rank[np.cumsum(left) - 1] = ranks.unknown
    filled = np.arange(len(ids)) - np.repeat(begins, sizes) < np.repeat(counts, sizes)
    return ids[filled], counts


class WordIds:
    """Token ids of the words of an Arrow array: short words all together, long ones one by one and remembered, within bounds."""

    def __init__(self, merges: Sequence[Merge], memo_words: int) -> None:
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.pair_ranks, self.memo_words = PairRanks(self.ranks), memo_words
        self.memo: dict[bytes, np.ndarray] = {}

    def _long(self, word: bytes) -> np.ndarray:
        found = self.memo.get(word)
        if found is None:
            found = np.array(merged_ids(word, self.ranks), np.int32)
            if len(self.memo) >= self.memo_words:
                self.memo.clear()
            self.memo[word] = found
        return found

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words in a row, first those of the short ones, where the ids of each word begin, and how many they are."""
        words = words.cast(pa.large_binary())
        _, places, data = words.buffers()
        places = np.frombuffer(places or bytes(8), np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(data or b"", np.uint8)[places[0] : places[-1]]
        lengths = np.diff(places)
        short = lengths <= HEAP_TOKENS
        begins, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ids, sizes[short] = many_merged_ids(data[np.repeat(short, lengths)], lengths[short], self.pair_ranks)
        long_ids = [self._long(words[i].as_buffer().to_pybytes()) for i in np.flatnonzero(~short).tolist()]
        sizes[~short] = [len(x) for x in long_ids]
        begins[short] = np.cumsum(sizes[short]) - sizes[short]
        begins[~short] = len(ids) + np.cumsum(sizes[~short]) - sizes[~short]
        return np.concatenate([ids, *long_ids]), begins, sizes


def word_encoder(merges: Sequence[Merge], memo_words: int = MEMO_WORDS):
    """Token ids of the pre-tokens of a text, as an Arrow function of a column of string arrays.

    Words repeat, so a batch encodes each distinct word once and copies the ids to its places as whole arrays. A task also
    remembers long words between batches; that memory is bounded and only saves time. Texts are encoded where they lie:
    nothing is shuffled.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = WordIds(merges, memo_words)
        for texts in batches:
            words = texts.flatten().dictionary_encode()
            which = words.indices.to_numpy()
            table, begins, sizes = encoder.of(words.dictionary)
            ends = np.concatenate([[0], np.cumsum(sizes[which])])
            place = np.arange(ends[-1]) + np.repeat(begins[which] - ends[:-1], sizes[which])
            bounds = texts.offsets.to_numpy().astype(np.int64)
            offsets = pa.array(ends[bounds - bounds[0]], pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(table[place], pa.int32()), mask=texts.is_null())

    return encode


def encoded(text: Column, merges: Sequence[Merge], prepend: int | None = None) -> Column:
    """Token ids of a text, with ``prepend`` in front when given. Special tokens in the text stay plain text."""
    ids = word_encoder(merges)(pretokens(text))
    return ids if prepend is None else F.concat(F.array(F.lit(prepend)), ids)


def _shared(value):
    """A table of one entry per token, sent once to each executor."""
    return SparkSession.active().sparkContext.broadcast(value)


def decoded(ids: Column, merges: Sequence[Merge], special: Sequence[str] = SPECIAL_TOKENS) -> Column:
    """Text of token ids, invalid bytes replaced; an id that is no token has no text."""
    values = [*token_values(merges), *(name.encode() for name in special)]
    table = _shared((np.frombuffer(b"".join(values), np.uint8), np.array([len(v) for v in values], np.int64)))

    @F.arrow_udf("binary")
    def spelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        data, sizes = table.value
        sizes = np.append(sizes, 0)  # for all other ids
        starts = np.cumsum(sizes) - sizes
        for lists in batches:
            tokens, bounds = _flat(lists)
            tokens = np.where((tokens < 0) | (tokens >= len(sizes)), len(sizes) - 1, tokens)
            lengths = sizes[tokens]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            places = np.repeat(starts[tokens] - ends[:-1], lengths) + np.arange(ends[-1])
            offsets = pa.array(ends[bounds], pa.int64())
            made = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, offsets.buffers()[1], pa.py_buffer(data[places].tobytes())])
            yield pc.if_else(lists.is_null(), None, made.cast(pa.binary()))

    return F.make_valid_utf8(spelled(ids).cast("string"))


def bytes_of(ids: Column, merges: Sequence[Merge]) -> Column:
    """Bytes that token ids stand for; special tokens have none."""
    table = _shared(np.array([len(v) for v in token_values(merges)], np.int64))

    @F.arrow_udf("bigint")
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = np.append(table.value, 0)
        for lists in batches:
            tokens, bounds = _flat(lists)
            tokens = np.where((tokens < 0) | (tokens >= len(sizes)), len(sizes) - 1, tokens)
            ends = np.concatenate([[0], np.cumsum(sizes[tokens])])
            yield pa.array(np.diff(ends[bounds]), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return measured(ids)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists, and where each list begins and the last one ends."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    return pc.fill_null(values, -1).to_numpy(zero_copy_only=False).astype(np.int64), bounds - bounds[0]


def with_token_bytes(tokens: DataFrame, vocab: DataFrame, token_id: str = "token_id") -> DataFrame:
    """Token rows with the byte length of their token. The vocabulary is bounded by its size parameter."""
    lengths = vocab.select(F.col("token_id").alias(token_id), "n_bytes", "raw_bytes", "is_special")
    return tokens.join(F.broadcast(lengths), token_id)


def token_counts(word_counts: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """How often each token occurs, from word counts (word, cnt): each distinct word is encoded once.

    A task adds up the counts of its words' tokens, so it returns at most one row per token.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = WordIds(merges, MEMO_WORDS), np.zeros(FIRST_MERGED + len(merges), np.int64)
        while held := _words_at_once(batches):
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, begins, sizes = encoder.of(rows.column("word").chunk(0))
            order = np.argsort(begins, kind="stable")  # as their ids lie
            np.add.at(total, ids, np.repeat(rows.column("cnt").to_numpy()[order], sizes[order]))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["token_id", "cnt"])

    words = word_counts.filter("word IS NOT NULL AND cnt IS NOT NULL").select("word", F.col("cnt").cast("bigint").alias("cnt"))
    counts = words.mapInArrow(counted, "token_id int, cnt bigint")
    return counts.groupBy("token_id").agg(F.sum("cnt").alias("cnt"))


def _words_at_once(batches: Iterator[pa.RecordBatch]) -> list[pa.RecordBatch]:
    """The next batches of at least ``WORDS_AT_ONCE`` rows together; none at the end."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= WORDS_AT_ONCE:
            break
    return held
