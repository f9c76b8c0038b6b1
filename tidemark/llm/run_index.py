"""Deduplication of long passages by a run-length index.

A byte is removed when a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id. How the
corpus is divided: any such string holds an anchor, a short string of least hash among those in it, chosen by content
alone. Anchors are counted over all documents; around those that occur in more than one, documents give pieces of text
to shards, and all pieces with the same anchor go to the same shard: that of the first document that has it, so a
passage stays in one piece as far as it has one origin.

A shard cuts its pieces into segments, keeps distinct ones, and builds their Burrows-Wheeler transform in run-length
form, with the suffix samples at run ends and, for each interval of suffixes that agree on ``LENGTH`` bytes, the
smallest document. Then all segments stream backwards through the runs at once: each step maps a row to the one
of the suffix a byte longer, and as soon as ``LENGTH`` bytes match, the interval tells the first document with them. What
is marked is decided on the bytes themselves; hashes only choose where pieces meet.

Anchors of very frequent passages go to shards of their own, and a block of documents sends equal pieces around them
once, for its smallest document: a larger one with the same piece loses all of it.

Defined cases: a null text is empty; a null id counts as larger than all others; rows that share an id never
remove each other's text; texts shorter than ``LENGTH`` stay; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.pandas.types as arrow_types
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.exchange import array, ascending, divided, packed, per_group, per_row, stage_arrays
from tidemark.llm.registry import query, table
from tidemark.llm.worker_memory import forget, frugal

LENGTH = 50
ANCHOR = 24
BLOCK_BYTES = 6_000_000
#: Text for each bucket of anchors, and for each shard of the index.
BUCKET_BYTES, SHARD_BYTES = 8_000_000, 6_000_000
SEGMENT = 400
#: An anchor in more documents than this is very frequent.
HOT_DOCUMENTS = 1_000
LAST = 2**63 - 1

_random = np.random.default_rng(24)
BYTE_HASH = _random.integers(1, 2**63, 256, dtype=np.uint64)
ODD = [int(v) | 1 for v in _random.integers(1, 2**63, 8, dtype=np.uint64)]


# --------------------------------------------------------------------------- anchors


def _windowed(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` over each ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        x = best(x[:-reach], x[reach:])
        reach *= 2
    return best(x[: len(x) - (width - reach)], x[width - reach :]) if width > reach else x


def anchors(text: np.ndarray, length: int = LENGTH, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of a text: in every ``length`` bytes, all strings of ``size`` with the least hash."""
    if len(text) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    by_size = {1: BYTE_HASH[text]}
    for i, n in enumerate((1, 2, 4, 8)):
        h = by_size[n]
        by_size[2 * n] = h[:-n] * np.uint64(ODD[i]) + h[n:]
    h16, h8 = by_size[16], by_size[8]
    count = len(text) - size + 1
    h = h16[:count] * np.uint64(ODD[5]) + h8[16 : 16 + count]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(ODD[6])
    h ^= h >> np.uint64(29)
    width = length - size + 1
    least = _windowed(h, width, np.minimum)  # of each window
    edge = np.zeros(width - 1, np.uint64)
    most = _windowed(np.concatenate([edge, least, edge]), width, np.maximum)  # largest least of the windows of a position
    at = np.flatnonzero(h == most)
    return at, h[at]


# --------------------------------------------------------------------------- the index of a shard


def suffix_order(chars: np.ndarray, rest: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and whether each row begins a new interval of suffixes that agree on ``length`` characters.

    ``chars`` holds segments, each ended by 0; ``rest`` is how many characters each suffix has, its end included. Ends
    differ: an earlier segment's is smaller.
    """
    n = len(chars)  # a few million: places fit in 32 bits
    key = np.zeros(n, np.int64)
    for j in range(7):
        key[: n - j] |= np.where(rest[: n - j] > j, chars[j:], 0).astype(np.int64) << (9 * (6 - j))
    order = np.argsort(key, kind="stable").astype(np.int32)
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    del key, ordered
    short = rest[order] <= 7
    new |= short
    new[1:] |= short[:-1]
    depth, starts = 7, None
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    while True:
        if depth == length:
            starts = new.copy()
        open_rows = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
        if not len(open_rows):
            break
        target = min(2 * depth, length) if depth < length else 2 * depth
        if 2 * depth < length < 4 * depth:
            target = -(-length // 2)
        at = order[open_rows]
        second = rank[at + target - depth]
        again = np.lexsort((second, rank[at]))
        at, second = at[again], second[again]
        order[open_rows] = at
        own = rank[at]
        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (second[1:] != second[:-1])])
        ended = rest[at] <= target  # ends differ, in the order of the segments
        fresh |= ended
        fresh[1:] |= ended[:-1]
        new[open_rows] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, open_rows, 0))
        depth = target
    return order, new if starts is None else starts


class RunIndex:
    """A run-length Burrows-Wheeler transform of segments, with samples at run ends and first documents of intervals."""

    def __init__(self, segments: list[bytes], documents: np.ndarray, length: int = LENGTH) -> None:
        self.length = length
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        ends = np.cumsum(sizes + 1)
        chars = np.zeros(int(ends[-1]), np.int16)
        body = np.ones(len(chars), bool)
        body[ends - 1] = False
        chars[body] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 1
        owner = np.repeat(np.arange(len(segments), dtype=np.int32), sizes + 1)
        rest = ends.astype(np.int32)[owner] - np.arange(len(chars), dtype=np.int32)
        order, interval = suffix_order(chars, rest, length)
        del rest
        transform = chars[order - 1]  # before the first suffix: the last end
        edge = np.concatenate([[True], transform[1:] != transform[:-1]])
        self.run_start = np.flatnonzero(edge)
        self.run_char = transform[self.run_start]
        self.samples = order[np.append(self.run_start[1:], len(order)) - 1]
        sizes_of_runs = np.diff(np.append(self.run_start, len(order)))
        by_char = np.argsort(self.run_char, kind="stable")
        base = np.empty(len(by_char), np.int64)
        base[by_char] = np.cumsum(sizes_of_runs[by_char]) - sizes_of_runs[by_char]
        self.shift = base - self.run_start
        #: The run and the interval of each row: a look at a table of a few million rows costs less than a search in their starts.
        self.run_of = np.cumsum(edge, dtype=np.int32) - np.int32(1)
        self.interval_of = np.cumsum(interval, dtype=np.int32) - np.int32(1)
        self.first_document = np.minimum.reduceat(documents[owner[order]], np.flatnonzero(interval))

    def first_documents(self, sizes: np.ndarray) -> np.ndarray:
        """For the indexed segments, of these sizes: at each position, the first document with the string that begins there.

        All segments stream backwards from their ends, which are the first rows. ``LAST`` where fewer bytes are left.
        """
        first = np.cumsum(sizes) - sizes
        out = np.full(int(sizes.sum()), LAST)
        by_size = np.argsort(-sizes, kind="stable")
        row, descending = by_size.copy(), -sizes[by_size]
        for step in range(1, int(sizes.max(initial=0)) + 1):
            active = int(np.searchsorted(descending, -step, "right"))
            row = row[:active]
            row = row + self.shift[self.run_of[row]]
            if step >= self.length:
                segment = by_size[:active]
                out[first[segment] + sizes[segment] - step] = self.first_document[self.interval_of[row]]
        return out


def covered(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end positions of the runs of bytes that strings beginning at ``starts`` (sorted) cover."""
    if not len(starts):
        return starts, starts
    edge = np.flatnonzero(np.diff(starts) > length)
    return starts[np.r_[0, edge + 1]], starts[np.r_[edge, len(starts) - 1]] + length


def _merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint, maximal runs."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    edge = np.flatnonzero(start[1:] > stop[:-1]) + 1
    return start[np.r_[0, edge]], stop[np.r_[edge - 1, len(stop) - 1]]


# --------------------------------------------------------------------------- over the corpus

BLOCK = "keys binary, sizes binary, text binary"


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of documents: ids, sizes and text of its documents; ``rest`` holds the other columns."""
    others = [c for c in docs.columns if c != "text"]
    fields = [docs.schema[c] for c in others]
    struct = pa.struct([pa.field(f.name, arrow_types.to_arrow_type(f.dataType)) for f in fields])
    names = ["rest", "keys", "sizes", "text"]
    at_id = others.index("doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        rest, keys, texts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            stored = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            row = [packed(np.array(keys, np.int64)), packed(sizes), stored]
            values = pa.array([rest], pa.list_(struct))
            return pa.record_batch([values, *(pa.array([v], pa.binary()) for v in row)], names=names)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            for i, text in enumerate(batch.column(0)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                rest.append(dict(zip(others, [c[i] for c in columns])))
                keys.append(LAST if columns[at_id][i] is None else columns[at_id][i])
                texts.append(data)
                size += len(data)
                if size >= block_bytes:
                    yield block()
                    rest, keys, texts, size = [], [], [], 0
        if texts:
            yield block()

    inner = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in fields)
    rows = docs.select("text", *others).mapInArrow(frugal(read), f"rest array<struct<{inner}>>, {BLOCK}")
    return stage_arrays(rows.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _block_anchors(text: bytes, sizes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors of a block, by ``bits`` of their hashes; of each occurrence, which it is, its place and its document.

    They are found anew wherever they are needed: an anchor takes more room on disk than the text that it stands for.
    """
    data, first = np.frombuffer(text, np.uint8), np.cumsum(sizes) - sizes
    found = [anchors(data[a : a + n]) for a, n in zip(first.tolist(), sizes.tolist())]
    place = np.concatenate([at + a for (at, _), a in zip(found, first.tolist())])
    document = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
    low = np.uint64(2**bits - 1)  # the upper bits of a least hash are mostly zero
    every, which = np.unique(np.concatenate([h for _, h in found]) & low, return_inverse=True)
    return every, which, place, document


def _segments(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments (piece, start, stop) of pieces; each overlaps the next so that no string of ``LENGTH`` is cut."""
    step = SEGMENT - LENGTH + 1
    count = np.maximum(1, -(-(stop - start - LENGTH + 1) // step))
    piece = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    begin = start[piece] + nth * step
    return piece, begin, np.minimum(begin + SEGMENT, stop[piece])


def with_spans(
    docs: DataFrame, hot_documents: int = HOT_DOCUMENTS, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Blocks of documents: rest (their other columns), text, sizes, and the removed runs of the block's text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(64, max(32, int(total).bit_length() + 8))  # one anchor in some 13 bytes: few share a hash by chance
    buckets, shards = int(total) // BUCKET_BYTES + 3, int(total) // shard_bytes + 3
    rows = _blocks(docs, block_bytes)

    def send(row: dict):
        keys, text = array(row["keys"]), zstandard.ZstdDecompressor().decompress(row["text"])
        every, which, _, document = _block_anchors(text, array(row["sizes"]), bits)
        order = np.lexsort((keys[document], which))
        which, owner = which[order], keys[document][order]
        new = np.concatenate([[True], which[1:] != which[:-1]])[: len(which)]
        least = owner[new]
        other = np.concatenate([[False], (which[1:] == which[:-1]) & (owner[1:] != owner[:-1])])[: len(which)]
        documents = 1 + np.bincount(which, other, len(every)).astype(np.int64)
        for bucket, at in divided(every, buckets):
            yield bucket, row["block"], ascending(every[at]), packed(least[at]), packed(documents[at])

    def home(bucket: int, group: list[dict]):
        hashes = [np.cumsum(array(r["hashes"], "u8")) for r in group]
        every, place = np.unique(np.concatenate(hashes), return_inverse=True)
        least = np.full(len(every), LAST)
        keys = np.concatenate([array(r["least"]) for r in group])
        np.minimum.at(least, place, keys)
        most = np.full(len(every), -LAST)
        np.maximum.at(most, place, keys)
        counts = np.concatenate([array(r["documents"]) for r in group])
        documents = np.bincount(place, counts)
        shared = (most != least) | (np.bincount(place, counts > 1) > 0)
        by_home = (least.astype(np.uint64) * np.uint64(ODD[7]) >> np.uint64(33)) % np.uint64(shards)
        by_anchor = every % np.uint64(shards)
        hot = documents > hot_documents
        shard = np.where(shared, 1 + 2 * np.where(hot, by_anchor, by_home).astype(np.int64) + hot, 0)  # even: hot
        at = 0
        for row, own in zip(group, hashes):
            yield bucket, row["block"], packed(shard[place[at : at + len(own)]])
            at += len(own)

    sent = per_row(rows.select("block", "keys", "sizes", "text"), send, "bucket bigint, block bigint, hashes binary, least binary, documents binary")
    homes = per_group(sent, "bucket", home, "bucket bigint, block bigint, shard binary")

    kinds = (("keys", "binary"), ("sizes", "binary"), ("text", "binary"))
    blank = lambda columns: [F.lit(None).cast(t).alias(c) for c, t in columns]
    asking = rows.select("block", *[c for c, _ in kinds], *blank((("bucket", "bigint"), ("shard", "binary"))))
    asking = asking.unionByName(homes.select("block", "bucket", "shard", *blank(kinds)))

    def pieces(block: int, group: list[dict]):
        row = next(r for r in group if r["text"] is not None)
        answers = {int(r["bucket"]): array(r["shard"]) for r in group if r["text"] is None}
        sizes, keys = array(row["sizes"]), array(row["keys"])
        text = zstandard.ZstdDecompressor().decompress(row["text"])
        every, which, place, document = _block_anchors(text, sizes, bits)
        first = np.cumsum(sizes) - sizes
        shard_of = np.zeros(len(every), np.int64)
        for bucket, at in divided(every, buckets):
            shard_of[at] = answers[bucket]
        shard = shard_of[which]
        chosen = shard > 0
        place, document, shard = place[chosen], document[chosen], shard[chosen]
        if not len(place):
            return
        begin = np.maximum(place - (LENGTH - ANCHOR), first[document])
        end = np.minimum(place + LENGTH, first[document] + sizes[document])
        order = np.lexsort((begin, document, shard))
        begin, end, document, shard = begin[order], end[order], document[order], shard[order]
        new = np.concatenate([[True], (shard[1:] != shard[:-1]) | (document[1:] != document[:-1]) | (begin[1:] > end[:-1])])
        new |= shard % 2 == 0  # pieces around very frequent anchors stay apart, so that equal ones can be told
        at = np.flatnonzero(new)
        start, stop, of, to = begin[at], end[np.append(at[1:], len(end)) - 1], document[at], shard[at]
        piece, a, b = _segments(start, stop)
        of, to = of[piece], to[piece]
        alone = np.ones(len(a), bool)
        marked_of, marked_a, marked_b = [], [], []
        seen: dict[tuple[int, bytes], int] = {}
        hot = np.flatnonzero(to % 2 == 0)
        for i in hot[np.argsort(keys[of[hot]], kind="stable")].tolist():
            name = (int(to[i]), text[a[i] : b[i]])
            owner = seen.setdefault(name, int(keys[of[i]]))
            if owner < keys[of[i]]:
                alone[i] = False
                marked_of.append(of[i])
                marked_a.append(a[i])
                marked_b.append(b[i])
        if marked_a:
            yield None, block, None, packed(np.array(marked_a)), packed(np.array(marked_b)), None
        a, b, of, to = a[alone], b[alone], of[alone], (to[alone] - 1) // 2
        for shard_, at in divided(to, shards):
            joined = b"".join([text[x:y] for x, y in zip(a[at].tolist(), b[at].tolist())])
            yield shard_, block, packed(keys[of[at]]), packed(a[at]), packed(b[at]), zstandard.ZstdCompressor(level=3).compress(joined)

    schema = "shard bigint, block bigint, keys binary, start binary, stop binary, text binary"
    found = stage_arrays(per_group(asking, "block", pieces, schema), "pieces")

    def match(shard: int, group: list[dict]):
        known: dict[bytes, int] = {}
        firsts: list[int] = []
        parts = []
        for row in group:
            text = zstandard.ZstdDecompressor().decompress(row["text"])
            keys, start, stop = array(row["keys"]), array(row["start"]), array(row["stop"])
            edge = np.cumsum(stop - start).tolist()
            which = np.empty(len(start), np.int64)
            for i, (x, y, key) in enumerate(zip([0, *edge[:-1]], edge, keys.tolist())):
                number = known.setdefault(text[x:y], len(known))
                which[i] = number
                if number == len(firsts):
                    firsts.append(key)
                elif key < firsts[number]:
                    firsts[number] = key
            parts.append((row["block"], keys, start, which))
        segments = list(known)
        known.clear()
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        earliest = RunIndex(segments, np.array(firsts, np.int64)).first_documents(sizes)
        offset = np.cumsum(sizes) - sizes
        for block, keys, start, which in parts:
            width = sizes[which]
            owner = np.repeat(np.arange(len(which)), width)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)
            hit = earliest[offset[which][owner] + inside] < keys[owner]
            begin = np.unique(start[owner[hit]] + inside[hit])
            if len(begin):
                a, b = covered(begin, LENGTH)
                yield block, packed(a), packed(b)

    spans = per_group(found.filter("shard IS NOT NULL"), "shard", match, "block bigint, start binary, stop binary")
    spans = spans.unionByName(found.filter("shard IS NULL").select("block", "start", "stop"))
    spans = spans.groupBy("block").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # one for each shard at most, and one
    return rows.select("block", "rest", "sizes", "text").join(spans, "block", "left")


def _documents(row: dict) -> Iterator[tuple[bytes, int, int]]:
    """(kept bytes, bytes, runs removed) of each document of a block."""
    text, sizes = zstandard.ZstdDecompressor().decompress(row["text"]), array(row["sizes"])
    spans = row["spans"] or []
    if spans:
        start, stop = _merged(*(np.concatenate([array(s[c]) for s in spans]) for c in ("start", "stop")))
    else:
        start = stop = np.empty(0, np.int64)
    ends = np.cumsum(sizes)
    for first, end in zip((ends - sizes).tolist(), ends.tolist()):
        # A run may reach over the border of two documents when both lose their adjoining ends.
        low, high = np.searchsorted(stop, first, "right"), np.searchsorted(start, end, "left")
        kept, at, runs = [], first, 0
        for a, b in zip(start[low:high].tolist(), stop[low:high].tolist()):
            kept.append(text[at : max(a, first)])
            at, runs = min(b, end), runs + 1
        kept.append(text[at:end])
        yield b"".join(kept), end - first, runs


def deduplicated(docs: DataFrame, texts: bool = True, **sizes: int) -> DataFrame:
    """The columns of ``docs`` but text, with n_bytes, n_removed, n_spans, kept_sha256, and ``text``, what is left of it.

    The text drops what is left of a character that lost some of its bytes.
    """
    others = [c for c in docs.columns if c != "text"]
    names = ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["text"] * texts
    blocks = with_spans(docs, **sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in zip(batch.schema.names[1:], batch.columns[1:])}
                rest = batch.column(0).slice(i, 1).flatten()
                found = [(n, n - len(k), runs, hashlib.sha256(k).hexdigest(), k) for k, n, runs in _documents(row)]
                columns = [pa.array(c) for c in zip(*(f[:4] for f in found))]
                if texts:
                    columns.append(pa.array([k.decode("utf-8", "ignore") for *_, k in found], pa.string()))
                yield pa.RecordBatch.from_arrays([rest, *columns], names=names)

    rest = blocks.schema["rest"].dataType.elementType.simpleString()
    schema = f"rest {rest}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", text string" * texts
    out = blocks.select("rest", "sizes", "text", "spans").mapInArrow(frugal(run), schema)
    return out.select(*[F.col("rest")[c].alias(c) for c in others], *names[1:])


@query("op3_run_index")
def run_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with what is removed from it."""
    return deduplicated(table(spark, folder, "documents").select("doc_id", "text"), texts=False)
