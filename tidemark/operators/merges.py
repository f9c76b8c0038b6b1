"""Training of byte-pair merges on word counts, many merges a round.

Trained one at a time, the next merge is the first pair in a total order: the most frequent first, ties by the ids of the left
and then the right token. A merge changes the counts of pairs that share a token with it only, and the pairs that it makes come
after the pairs that they are made from. So a pair that comes before every pair it shares a token with keeps its count and its
place until its turn comes, whatever is merged elsewhere: all such pairs are merged in one round, and the ids that they would
have got one at a time are assigned afterwards, in the total order.

The words stay distributed: a shard is one array of tokens and one of counts. A round applies its merges to the shards and
returns how the counts of pairs have changed, from the words that it changed only, in few bytes. The driver keeps the pair counts, whose
number is set by the size of the vocabulary and not by the corpus (65,536 pairs of bytes, and per merge at most two for each
token); a round changes few of them in place. Shards are small arrays that change each round, so they are a persisted RDD; every few rounds it is checkpointed in
the shared folder, which bounds what a lost executor makes Spark redo.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.staging import stage
from tidemark.session import shared_dir

Merge = tuple[int, int]

FIRST_MERGED = 256
#: Tokens of a shard are shifted by one; zero ends a word.
WORD_END = 0
SHARD_BYTES = 4_000_000


# --------------------------------------------------------------------------- shards


class Shard:
    """Words as one array of shifted tokens, each word in a slot that ``WORD_END`` fills up, and how often each word occurs.

    Words shrink within their slots, so a round costs one comparison of the array and else only the words that it changes.
    """

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        self.tokens, self.counts = tokens, counts

    @classmethod
    def of(cls, words: list[bytes], counts: list[int]) -> Shard:
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint16) + np.uint16(1)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        return cls(np.insert(data, ends, WORD_END), np.array(counts, np.int64))

    def _slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the slot of each word begins, and its length."""
        filled = self.tokens != WORD_END
        begins = np.flatnonzero(filled & np.concatenate([[True], ~filled[:-1]]))
        return begins, np.diff(begins, append=len(filled))

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = self._slots()[1]
        return _summed(*_weighted_pairs(self.tokens, np.repeat(self.counts, sizes)))

    def merged(self, batch: dict[Merge, int]) -> tuple[Shard, np.ndarray, np.ndarray]:
        """The shard after merges of pairs that share no token, and the changes of pair counts."""
        tokens = self.tokens
        size = max(max(max(pair) for pair in batch) + 1, max(batch.values()) + 1, int(tokens.max(initial=0))) + 2
        if size > np.iinfo(tokens.dtype).max:
            tokens = tokens.astype(np.uint32)
        partner, made = np.full(size, np.iinfo(tokens.dtype).max, tokens.dtype), np.zeros(size, tokens.dtype)
        for (left, right), new in batch.items():
            partner[left + 1], made[left + 1] = right + 1, new + 1
        at = np.flatnonzero(partner[tokens[:-1]] == tokens[1:])
        at = apart(at, tokens)
        if not len(at):
            return self, *_nothing()
        begins, sizes = self._slots()
        word = np.searchsorted(begins, at, "right") - 1
        changed = word[np.diff(word, prepend=-1) > 0]
        begins, sizes = begins[changed], sizes[changed]
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(changed)), sizes)
        slots = (begins - first)[owner] + np.arange(len(owner))
        old, weights = tokens[slots], self.counts[changed]
        here = at + np.repeat(first - begins, np.bincount(np.searchsorted(changed, word), minlength=len(changed)))
        new = old.copy()
        new[here] = made[old[here]]
        keep = old != WORD_END
        keep[here + 1] = False
        new, owner_after = new[keep], owner[keep]
        left = np.bincount(owner_after, minlength=len(changed))
        packed = np.zeros_like(old)
        packed[np.arange(len(new)) + np.repeat(first - (np.cumsum(left) - left), left)] = new
        before_keys, before = _weighted_pairs(old, weights[owner])
        after_keys, gained = _weighted_pairs(packed, weights[owner])
        delta = _summed(np.concatenate([before_keys, after_keys]), np.concatenate([-before, gained]))
        after = tokens.copy()
        after[slots] = packed
        return Shard(after, self.counts), *delta

    def without_short_words(self) -> Shard:
        """Words of one token have no pair left; the slots of the others are cut to their words."""
        sizes = self._slots()[1]
        filled = self.tokens != WORD_END
        word = np.repeat(np.arange(len(sizes)), sizes)
        stay = np.bincount(word[filled], minlength=len(sizes)) > 1
        keep = (filled | np.concatenate([[False], filled[:-1]])) & stay[word]
        return Shard(self.tokens[keep], self.counts[stay])


def _nothing() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def apart(at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Places of pairs without those that overlap the one before, as in a run of one token; the leftmost stay."""
    if not len(at):
        return at
    new_run = np.diff(at, prepend=-2) > 1
    start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
    odd = (np.arange(len(at)) - start) % 2 == 1
    return at[~odd]


def _weighted_pairs(tokens: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, weight) of every pair of neighbours in a word; the key holds both tokens. ``weights``: by place."""
    inside = np.flatnonzero((tokens[:-1] != WORD_END) & (tokens[1:] != WORD_END))
    keys = (tokens[inside].astype(np.int64) - 1 << 32) | (tokens[inside + 1].astype(np.int64) - 1)
    return keys, weights[inside]


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending keys and the sums of their values, without zero sums."""
    if not len(keys):
        return _nothing()
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    sums = np.add.reduceat(values, first)
    return keys[first][sums != 0], sums[sums != 0]


def sent(keys: np.ndarray, values: np.ndarray) -> list[bytes]:
    """Ascending keys, as differences, and values for the way to the driver, in the narrowest types and compressed."""
    out = []
    for numbers in (np.diff(keys, prepend=0), values):
        low, high = int(numbers.min(initial=0)), int(numbers.max(initial=0))
        kind = next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        planes = numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T if len(numbers) else numbers
        out.append(kind.encode() + zlib.compress(np.ascontiguousarray(planes).tobytes(), 1))
    return out


def received(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys and values that ``sent`` made bytes of."""
    found = []
    for part in parts:
        kind, planes = np.dtype(part[:2].decode()), np.frombuffer(zlib.decompress(part[2:]), np.uint8)
        numbers = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1)
        found.append(numbers.astype(np.int64))
    return np.cumsum(found[0]), found[1]


# --------------------------------------------------------------------------- what the driver keeps


class Pairs:
    """Pair counts, and which pairs to merge next."""

    def __init__(self) -> None:
        self.keys, self.counts = _nothing()
        self.pairs: list[Merge] = []  # of the merged tokens in the order in which they were made
        self.level = [np.iinfo(np.int64).max] * FIRST_MERGED  # the count of the pair that a token was made of
        self.final = {b: b for b in range(FIRST_MERGED)}  # the ids that are known for good
        self.merges: list[Merge] = []  # by final id
        self._ready: list[tuple[int, int, int, int]] = []
        self._waiting: dict[int, list[int]] = defaultdict(list)

    def add(self, changes: list[tuple[np.ndarray, np.ndarray]]) -> None:
        none = _nothing()
        keys, counts = _summed(*(np.concatenate([none[i], *(c[i] for c in changes)]) for i in (0, 1)))
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        self.counts[place[known]] += counts[known]
        stay = np.ones(len(self.keys), bool)
        stay[place[known]] = self.counts[place[known]] != 0
        place = place - np.concatenate([[0], np.cumsum(~stay)])[place]
        self.keys = np.insert(self.keys[stay], place[~known], keys[~known])
        self.counts = np.insert(self.counts[stay], place[~known], counts[~known])

    def _made(self, token: int) -> None:
        """A merged token gets its id once both its parts have theirs and it is its turn."""
        for part in self.pairs[token - FIRST_MERGED]:
            if part not in self.final:
                self._waiting[part].append(token)
                return
        left, right = (self.final[p] for p in self.pairs[token - FIRST_MERGED])
        heapq.heappush(self._ready, (-self.level[token], left, right, token))

    def _number(self, open_pairs: list[Merge], count: int) -> None:
        """Assign ids to made tokens until one of ``open_pairs``, all of the highest ``count`` left, is next."""
        blocked = defaultdict(list)
        until = (1, 0, 0)  # after any key
        for pair in open_pairs:
            until = min(until, self._turn(pair, count))
            for part in pair:
                blocked[part].append(pair)
        while self._ready and self._ready[0][:3] < until:
            _, left, right, token = heapq.heappop(self._ready)
            self.final[token] = FIRST_MERGED + len(self.merges)
            self.merges.append((left, right))
            for other in self._waiting.pop(token, ()):
                self._made(other)
            for pair in blocked.get(token, ()):
                until = min(until, self._turn(pair, count))

    def _turn(self, pair: Merge, count: int) -> tuple[int, int, int]:
        """The key of a pair in the total order; a pair has no turn before both its parts have ids."""
        left, right = (self.final.get(p) for p in pair)
        return (1, 0, 0) if left is None or right is None else (-count, left, right)

    def next_batch(self, n_merges: int) -> dict[Merge, int]:
        """Pairs that can be merged now, with their new tokens; none when the first ``n_merges`` ids are known."""
        if not len(self.keys):
            self._number([], 0)
            return {}
        # Pairs below this count are looked at later; how many are looked at changes no result.
        wide = max(64, 2 * (n_merges - len(self.merges)))
        floor = self.counts.min() if wide >= len(self.counts) else np.partition(self.counts, -wide)[-wide]
        among = np.flatnonzero(self.counts >= floor)
        left, right, count = self.keys[among] >> 32, self.keys[among] & 0xFFFFFFFF, self.counts[among]
        top = count.max()
        self._number(list(zip(left[count == top].tolist(), right[count == top].tolist())), int(top))
        if len(self.merges) >= n_merges:
            return {}
        place, unsure = self._order()
        order = np.lexsort((place[right], place[left], -count))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        tokens = len(self.level)
        first, most, times = np.full(tokens, len(order)), np.zeros(tokens, np.int64), np.zeros(tokens, np.int64)
        for side in (left, right):
            np.minimum.at(first, side, rank)
            np.maximum.at(most, side, count)
        for side, own in ((left, True), (right, left != right)):
            np.add.at(times, side, (count == most[side]) & own)
        chosen = (first[left] == rank) & (first[right] == rank)
        alone = (times[left] == 1) & (times[right] == 1)
        chosen &= alone | ~(unsure[left] | unsure[right])
        batch = {}
        for i in order[chosen[order]].tolist():
            pair = int(left[i]), int(right[i])
            batch[pair] = len(self.level)
            self.pairs.append(pair)
            self.level.append(int(count[i]))
        for token in batch.values():
            self._made(token)
        return batch

    def _order(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all tokens in the order of their final ids, and of which the place among equals is not known yet."""
        level = np.array(self.level)
        known = np.full(len(level), len(level) + 1)
        for token, number in self.final.items():
            known[token] = number
        order = np.lexsort((np.arange(len(level)), known, -level))
        place = np.empty(len(level), np.int64)
        place[order] = np.arange(len(level))
        open_ = known > len(level)
        values, at, size = np.unique(level[open_], return_inverse=True, return_counts=True)
        unsure = np.zeros(len(level), bool)
        unsure[open_] = size[at] > 1
        return place, unsure


# --------------------------------------------------------------------------- training


def _shards(words: DataFrame):
    """The shards of word counts (word, cnt), as an RDD."""
    rows = words.filter("cnt > 0 AND octet_length(word) > 1").select("word", F.col("cnt").cast("bigint").alias("cnt"))
    rows = stage(rows, "words")
    size = rows.agg(F.sum(F.octet_length("word") + 1)).first()[0] or 0
    parts = max(words.sparkSession.sparkContext.defaultParallelism, size // SHARD_BYTES)

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = [], []
        for batch in batches:
            held += [w.as_buffer().to_pybytes() for w in batch.column(0)]
            counts += batch.column(1).to_pylist()
        shard = Shard.of(held, counts).without_short_words()
        columns = [pa.array([x.tobytes()], pa.binary()) for x in (shard.tokens, shard.counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["tokens", "counts"])

    rows = rows.repartition(parts, "word").mapInArrow(built, "tokens binary, counts binary")
    return rows.rdd.map(lambda r: Shard(np.frombuffer(r[0], np.uint16), np.frombuffer(r[1], np.int64)))


def train(words: DataFrame, n_merges: int, rounds_per_stage: int = 32) -> list[Merge]:
    """Merges of a byte-pair vocabulary from word counts (word, cnt), most frequent pair first, ties by token ids."""
    shared_dir(words.sparkSession)  # sets the folder of checkpoints where there is none
    state = _shards(words).map(lambda shard: (shard, sent(*shard.pair_counts()))).persist()
    pairs = Pairs()
    pairs.add(_collected(state))
    rounds = 0
    while batch := pairs.next_batch(n_merges):
        rounds += 1
        tidy = rounds % rounds_per_stage == 0
        after = state.map(_step(batch, tidy)).persist()
        if tidy:
            after.checkpoint()
        pairs.add(_collected(after))
        state.unpersist()
        state = after
    state.unpersist()
    return pairs.merges[:n_merges]


def _collected(state) -> list[tuple[np.ndarray, np.ndarray]]:
    return [received(changes) for changes in state.map(lambda s: s[1]).collect()]


def _step(batch: dict[Merge, int], tidy: bool):
    def step(held: tuple[Shard, list[bytes]]) -> tuple[Shard, list[bytes]]:
        shard, keys, changes = held[0].merged(batch)
        return (shard.without_short_words() if tidy else shard), sent(keys, changes)

    return step
