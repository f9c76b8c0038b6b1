"""CRCs by columns against zlib, and the sample against a row-at-a-time version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_tables import awkward, documents  # noqa: F401
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidemark.llm import crc_resampling as cr


@given(st.lists(st.binary(max_size=40), max_size=60))
def test_crcs_of_equal_lengths_together(features):
    assert cr.crc32s(features).tolist() == [zlib.crc32(f) for f in features]


def test_crcs_of_very_long_features_and_split_arrays(monkeypatch):
    monkeypatch.setattr(cr, "CELLS", 50)
    features = [b"a" * n for n in (1, 511, 512, 513, 100_000)] + [b"%07d" % i for i in range(200)]
    assert cr.crc32s(features).tolist() == [zlib.crc32(f) for f in features]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def features(text, n):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    return len(words), runs


def brute(rows, target, n, buckets, percent):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text, n)[1])
    t = Counter(bucket(f) for text in target for f in features(text, n)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for doc_id, text in rows:
        words, found = features(text, n)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, weight + noise, words))
    eligible = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    count = len(eligible) * percent // 100
    ranks = {}
    for place, row in enumerate(eligible[:count], 1):
        ranks.setdefault(row, []).append(place)
    return sorted(((*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in out), key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


WORDS = "alpha Beta gamma déjà 12 x_y ZETA中文 eta theta iota Kappa".split()


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("chunk", [4_000_000, 40])
def test_sample_matches_brute_force(spark, documents, monkeypatch, n, chunk):
    monkeypatch.setattr(cr, "CHUNK_BYTES", chunk)  # the workers read it through the closure of a local function
    pick = np.random.default_rng(5)
    texts = [" ".join(pick.choice(WORDS, pick.integers(0, 60))) for _ in range(80)] + ["a-b" * 9, "x", "", None]
    rows = list(enumerate(texts))
    target = [" ".join(pick.choice(WORDS[:4], 30)) for _ in range(9)] + [None]
    towards = spark.createDataFrame([(t,) for t in target], "text string")
    got = found(cr.resampled(documents(texts), towards, n=n, buckets=97, percent=30))
    assert got == brute(rows, target, n, 97, 30)


def test_chunks_of_a_text_lose_no_feature(monkeypatch):
    text = (" ".join(WORDS) * 30).encode().translate(cr.WORD_BYTES)
    whole = list(cr.features_of(text, 3))
    monkeypatch.setattr(cr, "CHUNK_BYTES", 25)
    parts = list(cr.features_of(text, 3))
    assert len(parts) > 10 and len(whole) == 1
    assert Counter(f for _, fs in parts for f in fs) == Counter(whole[0][1])
    assert sum(words for words, _ in parts) == whole[0][0]


def test_awkward_rows(spark, awkward, documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    target = awkward.limit(0).select("text")
    assert found(cr.resampled(awkward, target)) == brute(rows, [], 1, 10_000, 10)
    empty = cr.resampled(documents([]), awkward.select("text"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_ties_and_repeated_rows_are_drawn_one_by_one(spark, documents):
    text = " ".join(["same"] * 25)
    got = found(cr.resampled(documents([text] * 40, [7] * 40), documents([text]).select("text"), percent=10))
    assert sorted(r[4] for r in got if r[4]) == [1, 2, 3, 4] and len(got) == 40


def test_columns_of_a_row_stay_with_it(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "n_words", "weight", "key")])
    rows = spark.createDataFrame([("one two", "a", "b", "c"), (None, None, None, None)], schema)
    got = cr.weighted(cr.hashed(rows, buckets=10), np.arange(10))
    assert got.columns == ["key", "n_words", "n_features", "weight"]
    assert {(r["key"], r["n_words"], r["n_features"]) for r in got.collect()} == {("c", 2, 2), (None, 0, 0)}
