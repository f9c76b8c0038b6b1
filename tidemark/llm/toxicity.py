"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel of two strings is the gap-weighted one: every subsequence of three characters that they share counts, the less
the more characters lie in between, in either. Characters inserted into an insult, or an ending put to it, so cost little.
Within ``SPAN`` characters these subsequences are few enough to be listed, so a string's kernel with all landmarks is a
lookup of its subsequences in one table.

A text is read as units: its words without punctuation, and runs of single characters read together, whole, without the
first one and sentence by sentence. Landmarks are units whose share among toxic training texts stands out, unlike each other
under the kernel.
Each text is represented by its largest kernel value with each landmark, mapped by the inverse root of the landmarks'
own kernel matrix; a linear support vector machine with squared hinge loss separates the classes there, and a sigmoid
fitted to its margins gives the score.

Training takes at most ``SAMPLE_ROWS`` labelled texts of each class, chosen by a hash of their ids. Every text is scored,
whole; of a very long unit each window of ``UNIT`` characters counts.

Defined cases: a null or empty text has no units and gets the score of a text without any likeness to a landmark; where
training texts show no landmark or only one class, every score is 0; conflicting labels of an id count as toxic; null
labels are ignored; repeated rows and null ids are scored like any other; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.worker_memory import forget, frugal, remembered

SAMPLE_ROWS = 10_000
LANDMARKS = 64
#: Decay per character, most characters from first to last of a subsequence, and most characters of a unit.
DECAY, SPAN, UNIT = 0.75, 8, 24
#: Kernel values below this count as none; landmarks are less alike than the second.
FLOOR, ALIKE = 0.35, 0.8
#: A landmark occurs in this many toxic texts, with this standard score against the others.
LEAST_TEXTS, LEAST_SCORE = 3, 4.0
REMEMBERED_WORDS = 400_000
#: Characters of landmarks are numbered in eight bits.
LETTERS = 256
TEXTS_AT_ONCE, UNITS_AT_ONCE = 256, 1_024

PUNCTUATION = dict.fromkeys(c for c in range(33, 127) if not chr(c).isalnum())
SENTENCE_END = re.compile(r"[.!?]+[ \t]+")
#: Three or more single characters in a row, each with any punctuation around it.
SPELLED_OUT = re.compile(r"(?<!\S)(?:[^\w\s]*\w[^\w\s]*[ \t]+){2,}[^\w\s]*\w[^\w\s]*(?!\S)")


def text_words(text: str) -> set[str]:
    """Lower-case words of a text, and its runs of single characters as one word each."""
    lower = text.lower()
    words = set(lower.split())
    for run in SPELLED_OUT.findall(lower):
        single = run.split()
        words.add("".join(single))
        words.add("".join(single[1:]))  # without a leading article
        words.update("".join(part.split()) for part in SENTENCE_END.split(run))
    return words


def word_units(word: str) -> list[str]:
    """A word without punctuation as units, none of them longer than ``UNIT``."""
    unit = word.translate(PUNCTUATION)
    if len(unit) <= UNIT:
        return [unit] if len(unit) > 2 else []
    return [unit[at : at + UNIT] for at in range(0, max(1, len(unit) - UNIT // 2), UNIT // 2)]


def text_units(text: str) -> set[str]:
    return {unit for word in text_words(text) for unit in word_units(word)}


# --------------------------------------------------------------------------- the kernel

_PLACES: dict[int, tuple[np.ndarray, ...]] = {}


def _places(length: int) -> tuple[np.ndarray, ...]:
    """Positions i < j < k within a span, and the weight of each, for strings of a length."""
    if length not in _PLACES:
        triples = [
            (i, j, k, DECAY ** (k - i + 1))
            for i in range(length)
            for k in range(i + 2, min(length, i + SPAN))
            for j in range(i + 1, k)
        ]
        i, j, k, weight = map(np.array, zip(*triples)) if triples else [np.empty(0, int)] * 4
        _PLACES[length] = i.astype(int), j.astype(int), k.astype(int), weight.astype(float)
    return _PLACES[length]


def _characters(units: list[str], length: int) -> np.ndarray:
    """One row of code points per unit. All units have the same length."""
    return np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(len(units), length)


def _codes(chars: np.ndarray, bits: int, kind: type = np.int64) -> np.ndarray:
    """One row per unit: a number for the characters, of so many bits each, at each of the places."""
    i, j, k, _ = _places(chars.shape[1])
    chars = chars.astype(kind)
    return chars[:, i] << 2 * bits | chars[:, j] << bits | chars[:, k]


def _norms(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The root of the kernel of each unit with itself: equal subsequences add up before they are squared."""
    order = np.argsort(codes, axis=1, kind="stable")
    ordered, weights = np.take_along_axis(codes, order, 1), weight[order]
    first = np.ones(ordered.shape, bool)
    first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    total = np.add.reduceat(weights.ravel(), np.flatnonzero(first.ravel()))
    out = np.zeros(len(codes))
    np.add.at(out, np.nonzero(first)[0], total**2)
    return np.sqrt(out)


@dataclass
class Landmarks:
    """Landmark strings and the table of their subsequences."""

    strings: list[str]
    seen: set[str] = field(default_factory=set, repr=False)
    #: Of the words seen, those like a landmark.
    alike: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    @cached_property
    def _letters(self) -> np.ndarray:
        """A small number for each code point of a landmark, zero for all others."""
        found = sorted({ord(c) for string in self.strings for c in string})
        if len(found) >= LETTERS:
            raise ValueError(f"landmarks of more than {LETTERS - 1} different characters")
        numbers = np.zeros(0x110000, np.uint8)
        numbers[found] = np.arange(1, len(found) + 1)
        return numbers

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Row of each subsequence code, or -1; and the normalised weights, one row per code, one column per landmark."""
        weights: dict[int, np.ndarray] = {}
        for column, string in enumerate(self.strings):
            chars, (*_, weight) = _characters([string], len(string)), _places(len(string))
            norm = _norms(_codes(chars, 21), weight)[0]
            for code, w in zip(_codes(self._letters[chars], 8)[0].tolist(), weight):
                weights.setdefault(code, np.zeros(len(self.strings)))[column] += w / norm
        rows = np.full(1 << 24, -1, np.int16)
        rows[list(weights)] = np.arange(len(weights))
        return rows, np.array(list(weights.values()))

    def kernel(self, units: list[str]) -> np.ndarray:
        """Normalised kernel of each unit with each landmark."""
        rows, weights = self._table
        out = np.zeros((len(units), len(self.strings)))
        for length in {len(u) for u in units if len(u) > 2}:
            at = np.array([i for i, u in enumerate(units) if len(u) == length])
            for part in np.array_split(at, len(at) // UNITS_AT_ONCE + 1):
                *_, weight = _places(length)
                chars = _characters([units[i] for i in part], length)
                known = rows[_codes(self._letters[chars], 8, np.int32)]
                owner, place = np.nonzero(known >= 0)
                if not len(owner):
                    continue
                shared = weight[place][:, None] * weights[known[owner, place]]
                edge = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                some = owner[edge]
                norms = _norms(_codes(chars[some], 21), weight)
                out[part[some]] = np.add.reduceat(shared, edge, axis=0) / norms[:, None]
        return out

    def likeness(self, texts: list[str]) -> np.ndarray:
        """For each text, the largest kernel value of any of its units with each landmark; small ones count as none."""
        if len(self.seen) > REMEMBERED_WORDS:
            self.seen, self.alike = set(), {}
        words = [text_words(text) for text in texts]
        new = set().union(*words) - self.seen
        units = [(word, unit) for word in new for unit in word_units(word)]
        values = self.kernel([unit for _, unit in units])
        for i in np.flatnonzero(values.max(axis=1, initial=0) >= FLOOR):
            word, value = units[i][0], np.where(values[i] >= FLOOR, values[i], 0)
            self.alike[word] = np.maximum(value, self.alike.get(word, 0))
        self.seen |= new
        out = np.zeros((len(texts), len(self.strings)))
        for row, own in zip(out, words):
            for word in own & self.alike.keys():
                np.maximum(row, self.alike[word], out=row)
        return out


def choose_landmarks(candidates: list[str], most: int = LANDMARKS) -> list[str]:
    """The first candidates, best first, that are not much like one chosen before."""
    chosen: list[str] = []
    for string in candidates:
        if not chosen or Landmarks(chosen[-1:]).kernel([string])[0, 0] < ALIKE and Landmarks(chosen).kernel([string]).max() < ALIKE:
            chosen.append(string)
        if len(chosen) == most:
            break
    return chosen


# --------------------------------------------------------------------------- the classifier


@dataclass(frozen=True)
class Model:
    landmarks: tuple[str, ...]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, likeness: np.ndarray) -> np.ndarray:
        margin = likeness @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -700, 700)))


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Minimiser of the weighted squared hinge loss plus a quadratic penalty."""
    theta = np.zeros(x.shape[1])
    for _ in range(50):
        slack = 1 - y * (x @ theta)
        on = slack > 0
        a = x[on] * weight[on, None]
        gradient = penalty * theta - a.T @ (y[on] * slack[on])
        step = np.linalg.solve(a.T @ x[on] + np.diag(penalty + 1e-9), gradient)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return theta


def _sigmoid(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability of a margin, with targets drawn in from 0 and 1."""
    plus, minus = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (plus + 1) / (plus + 2), 1 / (minus + 2))
    x, theta = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit_model(landmarks: list[str], likeness: np.ndarray, label: np.ndarray, cost: float = 10.0) -> Model:
    values, vectors = np.linalg.eigh(Landmarks(landmarks).kernel(landmarks))
    root = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    x = np.hstack([likeness @ root, np.ones((len(likeness), 1))])
    y = np.where(label == 1, 1.0, -1.0)
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum())) * len(label)
    theta = _newton(x, y, cost * share / len(label) * 100, np.r_[np.ones(len(landmarks)), 1e-6])
    slope, shift = _sigmoid(x @ theta, label)
    return Model(tuple(landmarks), root @ theta[:-1], float(theta[-1]), slope, shift)


# --------------------------------------------------------------------------- on tables


def held_out(doc_id: Column | str, folds: int = 5) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % folds == 0


def _arrow_texts(column: pa.Array) -> Iterator[str]:
    return (text or "" for text in column.to_pylist())


def _likeness(known: Landmarks, column: pa.Array) -> np.ndarray:
    parts = [column.slice(at, TEXTS_AT_ONCE) for at in range(0, max(1, len(column)), TEXTS_AT_ONCE)]
    return np.concatenate([known.likeness(list(_arrow_texts(part))) for part in parts])


def training_texts(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of at most ``most`` labelled documents of each class outside the held-out fold.

    Of rows that share an id, the one with the smallest hash of its text is taken.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("_h", F.xxhash64("doc_id"))
    some = [known.filter(F.col("toxic") == c).orderBy("_h", "doc_id").limit(most) for c in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(some[0].unionByName(some[1]).drop("_h")), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))


def fit(texts: DataFrame) -> Model | None:
    """A model from ``texts`` with text and toxic; None where they show no landmark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(_arrow_texts(batch.column(0)), batch.column(1).to_pylist()):
                counts[toxic].update(text_units(text))
            units = list(counts[0] | counts[1])
            columns = [pa.array(units, pa.string()), *(pa.array([c[u] for u in units], pa.int64()) for c in counts)]
            yield pa.record_batch(columns, names=["unit", "clean", "toxic"])

    totals = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    counted = texts.select("text", "toxic").mapInArrow(frugal(count), "unit string, clean bigint, toxic bigint")
    counted = counted.groupBy("unit").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = (F.col("clean") + F.col("toxic")) / sum(totals.values())
    spread = F.sqrt(both * (1 - both) * (1 / totals[0] + 1 / totals[1]))
    score = (F.col("toxic") / totals[1] - F.col("clean") / totals[0]) / spread
    best = counted.filter(F.col("toxic") >= LEAST_TEXTS).withColumn("score", score).filter(F.col("score") >= LEAST_SCORE)
    candidates = [r["unit"] for r in best.orderBy(F.desc("score"), "unit").limit(20 * LANDMARKS).collect()]
    if not candidates:
        return None
    landmarks = choose_landmarks(candidates)
    rows = with_likeness(texts, landmarks, "toxic").select("toxic", "likeness").collect()  # at most the sample
    return fit_model(landmarks, np.array([r["likeness"] for r in rows]), np.array([r["toxic"] for r in rows]))


def _landmarks(strings: tuple[str, ...]) -> Landmarks:
    """The landmarks with what a worker remembers of units that it has seen."""
    return remembered(("landmarks", strings), lambda: Landmarks(list(strings)))


def with_likeness(docs: DataFrame, landmarks: list[str], *kept: str) -> DataFrame:
    strings = tuple(landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _landmarks(strings)
        for batch in batches:
            found = _likeness(known, batch.column(0)).tolist()
            yield pa.record_batch([*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))], names=[*kept, "likeness"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "likeness array<double>"])
    return docs.select("text", *kept).mapInArrow(frugal(run), schema)


def scored(docs: DataFrame, model: Model | None, *kept: str) -> DataFrame:
    """The columns ``kept`` of all ``docs``, and score."""
    if model is None:
        return docs.select(*kept, F.lit(0.0).alias("score"))
    sent = [*dict.fromkeys(["text", *kept])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _landmarks(model.landmarks)
        for batch in batches:
            found = _likeness(known, batch.column(0))
            columns = [batch.column(sent.index(c)) for c in kept]
            yield pa.record_batch([*columns, pa.array(model.scores(found))], names=[*kept, "score"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "score double"])
    return docs.select(*sent).mapInArrow(frugal(run), schema)


@query("op4_kernel_toxicity")
def kernel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model of the labels outside the held-out fifth."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit(training_texts(docs, labels))
    return scored(docs, model, "doc_id").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
