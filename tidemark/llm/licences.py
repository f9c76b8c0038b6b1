"""Licence scans by a trained paragraph classifier.

Every paragraph of a text gets the probability of each licence family, of an unknown licence and of no licence from
sparse logistic regression over its 1- to 3-word n-grams. It is trained on variants and parts of the families' template
sentences, on the same sentences with what names the family replaced (unknown), and on everyday sentences and
paragraphs of the corpus that hold no template word pair (none). A temperature and the least probability of a family are set on held-out variants.

A family is only reported when a template confirms it: enough of the template's word tuples, and of those that name the
family, must occur in the paragraph. Families without confirmation are struck out and the probabilities of the rest are
compared. A licence that is not confirmed is unknown.

A paragraph is a line. Short lines may be a wrapped paragraph: a line that names no family by itself is also read
together with its neighbours (up to three lines that follow each other, none blank and none that names a family), and
the first such reading that names a family counts once, for all its lines and for those that run on from or into them.

By definition a paragraph without any of ``CUES`` has no features, in training as in scanning, so all such paragraphs
share one result, none, and are not classified one by one. Cues are fixed and do not depend on the corpus.

Fitted on bounded samples: ``VARIANTS`` of each sentence, and ``NEGATIVES`` paragraphs drawn from at most ``SAMPLE_DOCS``
documents of at most ``SAMPLE_BYTES``, chosen by a hash. Every paragraph of every document is scanned, whole.

Defined cases: a null or blank text has no paragraph and no family; equal paragraphs count each; null and repeated ids
are rows like any other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table

#: Sentences of public licences and of their notices; what is in braces names the family.
TEMPLATES = {
    "agpl": [
        "licensed under the {gnu affero general public license} version 3",
        "this program is free software under the terms of the {gnu affero general public license}",
        "under the terms of the {gnu affero general public license} as published by the free software foundation",
        "you should have received a copy of the {gnu affero general public license} along with this program",
        "{gnu affero general public license} version 3 19 november 2007",
        "spdx-license-identifier {agpl-3.0}",
        "spdx-license-identifier {agpl-3.0-only}",
        "spdx-license-identifier {agpl-3.0-or-later}",
    ],
    "apache-2.0": [
        "licensed under the {apache license} version 2.0",
        "you may not use this file except in compliance with the {apache license}",
        "{apache license} version 2.0 january 2004",
        "spdx-license-identifier {apache-2.0}",
    ],
    "bsd": [
        "released under the {bsd} license",
        "licensed under the {bsd} 3-clause license",
        "licensed under the {bsd} 2-clause license",
        "{redistribution and use in source and binary forms with or without modification are permitted}",
        "{redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer}",
        "{redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer}",
        "spdx-license-identifier {bsd-2-clause}",
        "spdx-license-identifier {bsd-3-clause}",
    ],
    "cc-by": [
        "licensed under {cc by 4.0}",
        "this work is licensed under a {creative commons attribution 4.0 international} license",
        "spdx-license-identifier {cc-by-4.0}",
    ],
    "cc-by-nc": [
        "licensed under {cc by-nc 4.0}",
        "this work is licensed under a {creative commons attribution noncommercial 4.0 international} license",
        "this work is licensed under a {creative commons attribution-noncommercial 4.0 international} license",
        "spdx-license-identifier {cc-by-nc-4.0}",
    ],
    "cc-by-sa": [
        "licensed under {cc by-sa 4.0}",
        "this work is licensed under a {creative commons attribution sharealike 4.0 international} license",
        "this work is licensed under a {creative commons attribution-sharealike 4.0 international} license",
        "spdx-license-identifier {cc-by-sa-4.0}",
    ],
    "cc0": [
        "released under {cc0 1.0 universal}",
        "dedicated to the {public domain} under {cc0}",
        "spdx-license-identifier {cc0-1.0}",
    ],
    "gpl": [
        "this work is licensed under the {gnu general public license} version 3",
        "licensed under the {gnu general public license} version 2 or later",
        "under the terms of the {gnu general public license} as published by the free software foundation",
        "you should have received a copy of the {gnu general public license} along with this program",
        "{gnu general public license} version 3 29 june 2007",
        "{gnu general public license} version 2 june 1991",
        "spdx-license-identifier {gpl-2.0}",
        "spdx-license-identifier {gpl-2.0-only}",
        "spdx-license-identifier {gpl-2.0-or-later}",
        "spdx-license-identifier {gpl-3.0}",
        "spdx-license-identifier {gpl-3.0-only}",
        "spdx-license-identifier {gpl-3.0-or-later}",
    ],
    "lgpl": [
        "licensed under the {gnu lesser general public license} version 3",
        "this library is licensed under the {gnu lesser general public license}",
        "under the terms of the {gnu lesser general public license} as published by the free software foundation",
        "you should have received a copy of the {gnu lesser general public license} along with this library",
        "{gnu lesser general public license} version 3 29 june 2007",
        "spdx-license-identifier {lgpl-2.1}",
        "spdx-license-identifier {lgpl-2.1-only}",
        "spdx-license-identifier {lgpl-2.1-or-later}",
        "spdx-license-identifier {lgpl-3.0}",
        "spdx-license-identifier {lgpl-3.0-only}",
        "spdx-license-identifier {lgpl-3.0-or-later}",
    ],
    "mit": [
        "released under the {mit license}",
        "licensed under the {mit license}",
        "the {mit license}",
        "{permission is hereby granted free of charge to any person obtaining a copy of this software}",
        "{the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability}",
        "spdx-license-identifier {mit}",
    ],
    "mpl-2.0": [
        "subject to the terms of the {mozilla public license} version 2.0",
        "subject to the terms of the {mozilla public license} v 2.0",
        "licensed under the {mozilla public license}",
        "spdx-license-identifier {mpl-2.0}",
    ],
    "proprietary": [
        "{all rights reserved}",
        "{copyright all rights reserved no part may be reproduced without permission}",
    ],
}
#: How a licence without a family is named; what is in braces is replaced.
OTHERS = ("the {own} license", "{own} license", "{own} public license version 1.0", "{own} license agreement", "distributed under the terms of the {own}", "spdx-license-identifier {own}")
#: Everyday uses of the cues, which declare nothing.
EVERYDAY = (
    "a driver license is needed", "he lost his fishing license", "they show a license before they drive", "a table was reserved for two", "the reserved rooms are upstairs", "reserved parking is behind the house", "tables are reserved",
    "she asked for permission to leave", "they gave permission to build a house", "the car has a warranty of two years", "a search warrant was issued",
    "the house of commons met today", "the domain of the king", "a domain name", "copyright law is old", "an apache helicopter landed", "the gnu is a large animal",
    "wealth was redistributed among them", "a reserved person who says little", "this belongs to the public domain of the town",
)
#: A paragraph about licences holds one of these, in lower case.
CUES = ("licen", "copyright", "permission", "redistribut", "warrant", "reserved", "gnu", "gpl", "spdx", "cc0", "cc by", "commons", "domain", "apache", "mozilla")
NONE, UNKNOWN = "none", "unknown"
WORD = re.compile(r"[a-z0-9](?:[a-z0-9.+-]*[a-z0-9+])?")
_CUES = tuple(c.encode() for c in CUES)
STARTS_LOWER = re.compile(rb"[^A-Za-z]*[a-z]")
VARIANTS, SAMPLE_DOCS, SAMPLE_BYTES, NEGATIVES = 30, 500, 10_000, 2_000
EPOCHS, RATE = 12, 0.5
#: Share of held-out decisions for a family that must be right.
PRECISION = 0.99
#: Shares of a template's word tuples, and of those of each part that names the family, that must be there.
CONFIRMED, NAMED = 0.6, 0.75
#: Longest line, in bytes, that may be part of a wrapped paragraph; lines of a reading.
WRAPPED, READ_LINES = 160, 3


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def features_of(words: list[str]) -> set[str]:
    """The n-grams of a paragraph with a cue; none without."""
    if not has_cue(" ".join(words).encode()):
        return set()
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def has_cue(lower: bytes) -> bool:
    for cue in _CUES:
        if cue in lower:
            return True
    return False


def _tuples(words: list[str], n: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(n))))


def _plain(sentence: str) -> list[str]:
    return sentence.translate({123: None, 125: None}).split()


def _wanted(sentence: str) -> list[tuple[int, set[tuple[str, ...]], float]]:
    """(n, word tuples, least share) of a whole template, triples or pairs if it is short, and of each naming part."""
    words = _plain(sentence)
    n = 3 if len(words) > 4 else 2
    out = [(n, _tuples(words, n), CONFIRMED)]
    for own in re.findall(r"\{([^}]*)\}", sentence):
        named = own.split()
        n = min(3, len(named))
        out.append((n, _tuples(named, n), CONFIRMED if len(named) == len(words) else NAMED))
    return out


_WANTED = {family: [_wanted(s) for s in sentences] for family, sentences in TEMPLATES.items()}


def confirmation(words: list[str], family: str) -> float:
    """The largest share of a template of the family whose word tuples occur in the words; 0 where none names it."""
    found = {n: _tuples(words, n) for n in (1, 2, 3)}
    best = 0.0
    for template in _WANTED[family]:
        shares = [len(wanted & found[n]) / len(wanted) for n, wanted, _ in template]
        if all(share >= least for share, (_, _, least) in zip(shares, template)):
            best = max(best, shares[0])
    return best


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]
    features: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, words: list[str]) -> np.ndarray:
        rows = [self.features[g] for g in sorted(features_of(words)) if g in self.features]
        z = self.bias + (self.weights[rows].sum(axis=0) / np.sqrt(len(rows)) if rows else 0)
        e = np.exp((z - z.max()) / self.temperature)
        return e / e.sum()

    def paragraph(self, words: list[str]) -> tuple[str, float]:
        """Class of a paragraph and the probability of a licence of any kind."""
        p = dict(zip(self.classes, self.probabilities(words).tolist()))
        licensed = 1 - p[NONE]
        confirmed = [f for f in TEMPLATES if confirmation(words, f) >= CONFIRMED]
        if confirmed:
            best = max(confirmed, key=p.get)
            left = p[NONE] + p[UNKNOWN] + sum(p[f] for f in confirmed)
            if p[best] >= self.threshold * left:
                return best, licensed
        return (UNKNOWN if licensed >= 0.5 else NONE), licensed

    @cached_property
    def plain(self) -> tuple[str, float]:
        """What every paragraph without a cue gives."""
        return self.paragraph([])

    def paragraphs(self, data: bytes) -> list[tuple[str, float]]:
        """Classes of the paragraphs of a text; those without a cue are one entry."""
        if not has_cue(data.lower()):
            return [self.plain] if data.strip() else []
        lines = data.split(b"\n")
        words = lambda i: words_of(lines[i].decode("utf-8", "replace"))
        alone = {i: self.paragraph(words(i)) for i, line in enumerate(lines) if has_cue(line.lower())}
        short = lambda i: 0 <= i < len(lines) and len(lines[i]) <= WRAPPED and bool(lines[i].strip())
        named = lambda i: alone.get(i, self.plain)[0] in TEMPLATES
        out = [self.plain] if any(i not in alone and line.strip() for i, line in enumerate(lines)) else []
        taken: set[int] = set()  # lines of a reading that names a family
        for i in sorted(alone):
            if named(i):
                out.append(alone[i])
                taken.add(i)
        for i in sorted(alone):
            spans = [range(first, first + size) for size in range(2, READ_LINES + 1) for first in range(i - size + 1, i + 1)]
            for span in spans if i not in taken else []:
                if all(short(k) and k not in taken for k in span):
                    read = self.paragraph([w for k in span for w in words(k)])
                    if read[0] in TEMPLATES:
                        out.append(read)
                        taken.update(span)
                        break
        # A line without an end that runs on, in lower case, a paragraph with a family, or goes on with one, is part of it.
        runs_on = lambda i: short(i) and short(i + 1) and lines[i].rstrip()[-1:] not in b".!?" and STARTS_LOWER.match(lines[i + 1]) is not None
        for order, step in ((sorted(alone), -1), (sorted(alone, reverse=True), 1)):
            for i in order:
                if i + step in taken and runs_on(min(i, i + step)):
                    taken.add(i)
        return out + [alone[i] for i in alone if i not in taken]

    def text(self, data: bytes) -> tuple[list[str], int, float]:
        """Families of a text, in order; its licence paragraphs; the largest probability of a licence."""
        found = self.paragraphs(data)
        kinds = [kind for kind, _ in found if kind != NONE]
        return sorted(set(kinds)), len(kinds), max((p for _, p in found), default=0.0)


def _variants(random: np.random.Generator, filler: list[str]) -> list[tuple[str, list[str]]]:
    """(class, words) of the templates' variants."""
    out = []
    pick = lambda n: [filler[i] for i in random.integers(0, len(filler), n)]
    for family, sentences in TEMPLATES.items():
        for sentence in sentences:
            parts = re.findall(r"\{([^}]*)\}|([^{}]+)", sentence)
            for i in range(VARIANTS):
                kind = family if i % 3 or all(own for own, _ in parts) else UNKNOWN
                words = []
                for own, other in parts:
                    words += pick(random.integers(1, 4)) if own and kind == UNKNOWN else (own or other).split()
                if i % 5 == 4 and len(words) > 8:  # a part, as of a wrapped line
                    size = random.integers(len(words) * 2 // 3, len(words))
                    first = random.integers(0, len(words) - size + 1)
                    if kind == UNKNOWN or confirmation(words[first : first + size], family) >= CONFIRMED:
                        words = words[first : first + size]
                words = [w for w in words if len(words) < 4 or random.random() > 0.05] or words
                if i % 2:
                    words = pick(random.integers(0, 5)) + words + pick(random.integers(0, 5))
                out.append((kind, words))
    for kind, sentences in ((UNKNOWN, OTHERS), (NONE, EVERYDAY)):
        for sentence in sentences:
            for i in range(VARIANTS // 2):
                words = [x for w in sentence.split() for x in (pick(random.integers(1, 4)) if w == "{own}" else [w])]
                out.append((kind, words if i % 3 else pick(random.integers(0, 5)) + words + pick(random.integers(0, 5))))
    return out


def fit(paragraphs: list[str], seed: int = 5) -> Model:
    """A model from paragraphs of the corpus."""
    random = np.random.default_rng(seed)
    pairs = {p for s in TEMPLATES.values() for t in s for p in _tuples(_plain(t), 2) if has_cue(" ".join(p).encode())}
    plain = [w for w in map(words_of, paragraphs) if w and pairs.isdisjoint(zip(w, w[1:]))]
    # Paragraphs with a cue come first: the others have no features and are all alike.
    drawn = sorted(random.permutation(len(plain)).tolist(), key=lambda i: not features_of(plain[i]))
    plain = [plain[i] for i in drawn[:NEGATIVES]]
    filler = sorted({w for words in plain for w in words})[:20_000] or ["word"]
    samples = _variants(random, filler) + [(NONE, w) for w in plain] + [(NONE, [])]
    classes = (*TEMPLATES, UNKNOWN, NONE)
    names = {c: i for i, c in enumerate(classes)}
    order = random.permutation(len(samples))
    held, train = order[: len(order) // 5], order[len(order) // 5 :]
    counts = Counter(g for i in train for g in features_of(samples[i][1]))
    features = {g: k for k, g in enumerate(sorted(g for g, n in counts.items() if n > 1))}
    weights, bias = np.zeros((len(features), len(classes))), np.zeros(len(classes))
    squares, own_squares = np.full(len(features), 1e-3), 1e-3
    rows = {i: np.array([features[g] for g in sorted(features_of(samples[i][1])) if g in features], np.int64) for i in train}
    for _ in range(EPOCHS):
        for i in random.permutation(train):
            at = rows[i]
            scale = 1 / np.sqrt(max(1, len(at)))
            z = bias + weights[at].sum(axis=0) * scale
            p = np.exp(z - z.max())
            p /= p.sum()
            p[names[samples[i][0]]] -= 1
            step = float(p @ p)
            squares[at] += step * scale**2
            own_squares += step
            weights[at] -= RATE * scale / np.sqrt(squares[at])[:, None] * p
            bias -= RATE / np.sqrt(own_squares) * p

    draft = Model(classes, features, weights, bias, 1.0, 0.5)
    logits = [np.log(draft.probabilities(samples[i][1]) + 1e-12) for i in held]
    truth = [names[samples[i][0]] for i in held]

    def loss(t: float) -> float:
        return -sum(z[k] / t - np.log(np.exp((z - z.max()) / t).sum()) - z.max() / t for z, k in zip(logits, truth))

    temperature = min(np.geomspace(0.25, 4, 17), key=loss)
    calibrated = Model(classes, features, weights, bias, float(temperature), 0.5)
    decided = sorted(
        ((float(p[: len(TEMPLATES)].max()), int(np.argmax(p[: len(TEMPLATES)])) == k) for p, k in zip((calibrated.probabilities(samples[i][1]) for i in held), truth)),
        reverse=True,
    )
    right = np.cumsum([ok for _, ok in decided]) / np.arange(1, len(decided) + 1)
    good = np.flatnonzero(right >= PRECISION)
    threshold = max(0.5, decided[good[-1]][0]) if len(good) else 1.0
    return Model(classes, features, weights, bias, float(temperature), float(threshold))


def sample_paragraphs(docs: DataFrame) -> list[str]:
    """Paragraphs of a bounded number of documents of bounded size, chosen by a hash."""
    some = docs.filter("doc_id IS NOT NULL").filter(F.octet_length("text").between(1, SAMPLE_BYTES)).select("doc_id", "text")
    # Only ids are ordered; texts of the chosen ones are fetched afterwards.
    chosen = some.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    texts = some.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.orderBy("doc_id").collect()
    return [line for r in rows for line in r.text.split("\n")]


def scanned(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, families, n_paragraphs (with a licence) and probability of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.text(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]
            families, counts, most = zip(*found) if found else ([], [], [])
            columns = [batch.column(0), pa.array(families, pa.list_(pa.string())), pa.array(counts, pa.int64()), pa.array(most, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "families", "n_paragraphs", "probability"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, families array<string>, n_paragraphs bigint, probability double")


@query("op5_licence_families")
def licence_families(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the licence families that its paragraphs declare."""
    docs = table(spark, folder, "documents")
    return scanned(docs, fit(sample_paragraphs(docs)))
