"""Packing documents into sequences by shortest-pack-first over the length histogram.

Documents are encoded and cut into pieces of at most ``capacity`` tokens. Only the histogram of piece lengths, at most
``capacity`` numbers whatever the corpus, is packed: lengths are placed longest first, each into the packs that are
shortest so far, as counts of patterns. Then every piece gets its rank among the pieces of its length, and a range of
ranks maps to a slot of a pattern, so the patterns are joined back to the pieces. A rank is a position in one of many
buckets of rows plus the counts of the buckets before it; no length, however frequent, is sorted in one task.

Defined cases: a null text is empty; every document ends with the end token, so an empty one is a piece of one token;
repeated rows and null ids are packed like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.worker_memory import frugal, remembered
from tidemark.plans.staging import stage

CAPACITY = 4_096
END_TOKEN = 2
#: Slots, of six numbers each, that are sent to all executors.
BROADCAST_SLOTS = 500_000
#: Rows ranked together.
BUCKET_ROWS = 4_000
#: Words whose ids a worker remembers, twice.
REMEMBERED_WORDS = 300_000
#: Bytes of texts that are encoded together.
BYTES_AT_ONCE = 4_000_000

PIECES = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


# --------------------------------------------------------------------------- encoding and cutting


#: A full stop or comma after one of these at the end of a word is a piece of its own.
PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
MARKS = (b".", b",")


class WordIds:
    """The ids of words as little-endian 32-bit integers.

    The vocabulary lowers case and never joins text across white space, so words are encoded once each. Of the words seen
    before, a worker remembers the latest.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads beside it cost more than they bring
        self.definition, self.tokenizer = definition, Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        special = [(i, t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.between = next(((token, i) for i, token in special), None)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks = {mark: self._each([mark])[0] for mark in MARKS}

    def _each(self, words: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Words of letters make one piece each, as a rule: many are encoded as one text and told apart by piece ends."""
        found: list[bytes] = []
        parts = [words[at : at + 64] for at in range(0, len(words), 64)]
        texts = [b" ".join(part).decode("utf-8", "replace") for part in parts]
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            at = np.flatnonzero(self.ends[ids]) + 1
            data = ids.tobytes()
            if len(at) == len(part) and at[-1] == len(ids):
                edges = (4 * np.append(0, at)).tolist()
                found += [data[a:b] for a, b in zip(edges, edges[1:])]
            else:  # lower case or composition has made more pieces of a word
                found += self._each(part)
        return found

    def _apart(self, words: list[bytes]) -> list[bytes]:
        """Other words make any number of pieces: many are encoded as one text with a special token between them."""
        if self.between is None:
            return self._each(words)
        token, number = self.between
        found: list[bytes] = []
        parts = [words[at : at + 64] for at in range(0, len(words), 64)]
        texts = [(b" %b " % token).join(part).decode("utf-8", "replace") for part in parts]
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(encoded.ids, "<u4")
            at = np.flatnonzero(ids == number)
            data = ids.tobytes()
            if len(at) == len(part) - 1:
                found += [data[a:b] for a, b in zip([0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(data)])]
            else:  # a word holds that token
                found += self._each(part)
        return found

    def _add(self, new: list[bytes]) -> None:
        """Encode new words; those with a last mark from the word before it."""
        recent, older = self.recent, self.older
        marked = [w for w in new if w[-1:] in self.marks and w[-2:-1] and w[-2] in PLAIN]
        stems = {w[:-1] for w in marked}.union(new).difference(marked)
        plain, other = [], []
        for stem in stems:
            if stem in recent:
                continue
            if stem in older:
                recent[stem] = older[stem]
            else:
                (plain if stem.isalpha() or (not stem.isascii() and stem.decode("utf-8", "replace").isalpha()) else other).append(stem)
        recent.update(zip(plain, self._plain(plain)))
        recent.update(zip(other, self._apart(other)))
        for word in marked:
            recent[word] = recent[word[:-1]] + self.marks[word[-1:]]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text. Their distinct words are looked up once; those not remembered are encoded together."""
        if len(self.recent) > REMEMBERED_WORDS:
            self.recent, self.older = {}, self.recent
        recent, older = self.recent, self.older
        # A special token is told from other text by its case.
        lowered = pa.array([text if b"<|" in text else text.lower() for text in texts], pa.large_binary()).view(pa.large_string())
        split = pc.ascii_split_whitespace(lowered)
        places = split.flatten().dictionary_encode()
        _, edges, data = places.dictionary.buffers()
        edges, data = np.frombuffer(edges or bytes(8), np.int64)[: len(places.dictionary) + 1].tolist(), (data or pa.py_buffer(b"")).to_pybytes()
        words = [data[begin:end] for begin, end in zip(edges, edges[1:])]
        recent[b""] = b""  # beside white space at an end
        known = list(map(recent.get, words))
        gaps = [(i, words[i]) for i, ids in enumerate(known) if ids is None]
        new = []
        for _, word in gaps:
            if word in older:
                recent[word] = older[word]
            else:
                new.append(word)
        self._add(new)
        for i, word in gaps:
            known[i] = recent[word]
        table, which = np.frombuffer(b"".join(known), "<u4"), places.indices.to_numpy()
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begins, lengths = np.cumsum(sizes) - sizes, sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = table[np.arange(ends[-1]) + np.repeat(begins[which] - ends[:-1], lengths)]
        bounds = split.offsets.to_numpy()
        bounds = ends[bounds - bounds[0]].tolist()
        for begin, end in zip(bounds, bounds[1:]):
            yield ids[begin:end].tobytes()


def _in_parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in lists of about ``BYTES_AT_ONCE``."""
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64) // BYTES_AT_ONCE
    edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
    for begin, end in zip(edges, edges[1:]):
        if begin < end:
            yield texts[begin:end]


def _encoder(definition: str) -> WordIds:
    """One encoder stays in a worker while it packs, with the words that it remembers."""
    return remembered(("words", definition), lambda: WordIds(definition))


def tokenizer_definition(path: str | None = None) -> str:
    """The text of a tokenizer file, read once by the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY, end: int = END_TOKEN, ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, and with ``ids`` the tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    tail = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            rows, starts, lengths, sums, totals, tokens = [], [], [], [], [], []
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
            encoded = (ids for some in _in_parts(texts) for ids in encoder.encode(some))
            for i, ids_of_text in enumerate(encoded):
                data = ids_of_text + tail
                for at in range(0, len(data), 4 * capacity):
                    piece = data[at : at + 4 * capacity]
                    rows.append(i)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(data) // 4)
                    if ids:
                        tokens.append(np.frombuffer(piece, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (starts, lengths, sums, totals)]
            columns += [pa.array(tokens, pa.list_(pa.int32()))] if ids else []
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * ids)

    schema = PIECES.format(docs.schema["doc_id"].dataType.simpleString()) + ", ids array<int>" * ids
    return docs.select("doc_id", "text").mapInArrow(frugal(cut), schema)


# --------------------------------------------------------------------------- packing the histogram


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packing patterns, which use up the histogram.

    Longest lengths come first; each goes to the packs with the most room. Where none has room, as many new packs are
    opened as the length needs when they are filled with it alone.
    """
    open_packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    done = []

    def put(count: int, pattern: tuple[int, ...], room: int) -> None:
        (open_packs[room] if room else done).append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = capacity
        while left:
            while room >= length and not open_packs.get(room):
                room -= 1
            if room < length:
                new = -(-left // (capacity // length))
                put(new, (length,), capacity - length)
                left -= new
                room = capacity - length
                continue
            count, pattern = open_packs[room].pop()
            used = min(count, left)
            if count > used:
                open_packs[room].append((count - used, pattern))
            put(used, (*pattern, length), room - length)
            left -= used
    return done + [pack for packs in open_packs.values() for pack in packs]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, used) of each slot of each pattern."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset, used = 0, sum(lengths)
        for length in lengths:
            rows.append((length, taken[length], taken[length] + count, sequence, offset, used))
            taken[length] += count
            offset += length
        sequence += count
    return rows


# --------------------------------------------------------------------------- ranks


def ranked(rows: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows``, a stored table with a unique ``row``, and ``rank`` from 0 among those of the same ``key``."""
    buckets = -(-rows.count() // bucket_rows) or 1
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = rows.groupBy(key, "_bucket").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(key).orderBy("_bucket")) - F.col("_rows")
    counts = counts.select(key, "_bucket", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy("row")) - 1
    out = rows.withColumn("_within", within).join(counts, [key, "_bucket"])
    return out.withColumn("rank", F.col("_before") + F.col("_within")).drop("_bucket", "_before", "_within")


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, end: int = END_TOKEN, ids: bool = False) -> DataFrame:
    """The pieces of all documents with sequence_id, offset and padded_length.

    A sequence is padded to ``capacity`` unless its length is a power of two.
    """
    spark = docs.sparkSession
    rows = stage(pieces(docs, definition, capacity, end, ids).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    schema = "length bigint, first bigint, stop bigint, sequence bigint, offset bigint, used bigint"
    where_to = slots(pack_histogram(histogram, capacity))
    places = spark.createDataFrame(where_to, schema)
    places = F.broadcast(places) if len(where_to) <= BROADCAST_SLOTS else places  # else Spark splits the longest groups
    narrow = ranked(rows.select("row", "length"), "length")
    where = (narrow["length"] == places["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    placed = narrow.join(places, where).select(
        "row", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset", "used"
    )
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    padded = F.when(power, F.col("used")).otherwise(capacity).alias("padded_length")
    return rows.join(placed, "row").select(*[c for c in rows.columns if c != "row"], "sequence_id", "offset", padded)


@query("op2_packed_pieces")
def packed_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return pack(table(spark, folder, "documents"), tokenizer_definition())
