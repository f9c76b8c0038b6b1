"""SimHash groups and removed passages beside brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from llm_tables import LONG, SMALL, awkward, documents  # noqa: F401

from tidemark.llm import run_index as ri
from tidemark.llm import simhash_trie as st


def naive_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(prints, budget=3):
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= budget:
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("group_rows", [20_000, 4])
def test_components_equal_brute_force(spark, monkeypatch, group_rows):
    monkeypatch.setattr(st, "GROUP_ROWS", group_rows)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    ids = sorted(texts)
    prints = [naive_print(texts[i]) for i in ids]
    wanted = {i: (p, ids[c]) for i, p, c in zip(ids, prints, naive_components(prints))}
    found = st.near_duplicates(docs.select("doc_id", "text"), 3).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in found} == wanted
    assert sorted(r.doc_id for r in st.one_of_each(docs, 3).collect()) == sorted({c for _, c in wanted.values()})


def test_trie_in_dense_groups():
    random_ = np.random.default_rng(3)
    centres = random_.integers(0, 2**63, 4, dtype=np.uint64)
    flips = [np.uint64(1) << random_.integers(0, 64, 150, dtype=np.uint64) for _ in range(4)]
    prints = np.unique(np.concatenate([c ^ flips[0] ^ flips[1] ^ flips[2] ^ flips[3] for c in centres]))
    got = st.trie_links(np.zeros(len(prints), np.int64), prints)
    assert got.tolist() == naive_components([int(p) for p in prints])


def test_chains_become_stars(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    found = {r.node: r.root for r in st.stars(edges).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {101: 100}


def test_awkward_rows_near_duplicates(awkward, documents):
    found = st.near_duplicates(awkward.select("doc_id", "text"), 3).collect()
    assert len(found) == awkward.count()
    blank = [r for r in found if r.fp == 0]
    assert {r.doc_id for r in blank} == {0, 1, 2, None} and {r.component_id for r in blank} == {0}
    kept = st.one_of_each(awkward, 3)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and 8 not in ids and 0 in ids and 1 not in ids
    assert st.one_of_each(documents([]), 3).count() == 0


# --------------------------------------------------------------------------- passages


def naive_passages(rows):
    """{(id, text): (bytes, removed, spans, digest)} for (id, text) in order of ids."""
    first, out = {}, []
    rows = sorted(((2**63 if i is None else i), (t or "").encode()) for i, t in rows)
    for i, data in rows:
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], i)
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < i:
                gone[at : at + 50] = True
        spans = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(docs, **sizes):
    rows = ri.deduplicated(docs, **sizes).collect()
    return sorted((2**63 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def repetitive(count=60):
    draw = random.Random(5)
    shared = ["".join(draw.choice("abcdé ") for _ in range(n)) for n in (49, 50, 51, 300, 2_000)]
    texts = []
    for _ in range(count):
        parts = [draw.choice(shared) if draw.random() < 0.5 else "".join(draw.choice("abcdé ") for _ in range(40)) for _ in range(6)]
        texts.append("".join(parts))
    return texts + ["a" * 700, "a" * 120, "a" * 49, texts[0], texts[3][1:]]


@pytest.mark.parametrize("sizes", [{}, {"hot_documents": 2, "block_bytes": 5_000, "shard_bytes": 20_000}])
def test_passages_equal_brute_force(documents, sizes):
    texts = repetitive()
    assert removed(documents(texts), **sizes) == naive_passages(enumerate(texts))


def test_awkward_rows_passages(awkward, documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.text is None or len(r.text) < 100_000]
    short = documents([t for _, t in rows], [i for i, _ in rows])
    assert removed(short) == naive_passages(rows)
    found = ri.deduplicated(awkward)
    assert set(awkward.columns) < set(found.columns) and found.count() == awkward.count()
    assert ri.deduplicated(documents([])).count() == 0


def test_every_long_string_has_an_anchor():
    text = np.frombuffer(random.Random(1).randbytes(2_000) + b"a" * 200, np.uint8)
    at, _ = ri.anchors(text)
    for start in range(len(text) - ri.LENGTH + 1):
        assert np.any((at >= start) & (at <= start + ri.LENGTH - ri.ANCHOR))


def test_streaming_looks_rows_up_in_tables():
    """No step searches among the starts of runs or intervals."""
    segments = [b"banana" * 20, b"bananas" * 17, b"x" * 30]
    index = ri.RunIndex(segments, np.array([5, 3, 1]))
    rows = np.arange(sum(map(len, segments)) + len(segments))
    assert np.array_equal(index.run_of, np.searchsorted(index.run_start, rows, "right") - 1)
    assert len(index.interval_of) == len(rows) and index.interval_of[-1] == len(index.first_document) - 1


def test_index_runs_and_samples():
    segments = [b"banana" * 20, b"bananas" * 17, b"x" * 30]
    index = ri.RunIndex(segments, np.array([5, 3, 1]))
    text = b"\0".join(segments) + b"\0"
    assert len(index.run_start) < len(text) / 3  # repetitive text has few runs
    sizes = np.array([len(s) for s in segments])
    first = index.first_documents(sizes)
    joined, at = b"".join(segments), 0
    for s in segments:
        for i in range(len(s) - 49):
            wanted = min(d for d, other in zip((5, 3, 1), segments) if s[i : i + 50] in other)
            assert first[at + i] == wanted
        at += len(s)
    assert len(joined) == at


def test_blocks_hold_no_anchors(documents):
    """Anchors that are stored take more room than the text; they are found anew from it."""
    texts = [LONG[i : i + 3_000] for i in range(0, 60_000, 2_500)] + [None, "", "short"]
    rows = ri._blocks(documents(texts).select("doc_id", "text"), 20_000)
    stored = sum(len(r[c]) for r in rows.collect() for c in r.asDict() if isinstance(r[c], bytes))
    assert stored < 0.7 * sum(len(t or "") for t in texts)
    joined, sizes = "".join(t or "" for t in texts).encode(), np.array([len(t or "") for t in texts])
    every, which, place, document = ri._block_anchors(joined, sizes, 64)
    begin = np.cumsum(sizes) - sizes
    plain = [(d, int(at) + begin[d], h) for d, t in enumerate(texts) for at, h in zip(*ri.anchors(np.frombuffer((t or "").encode(), np.uint8)))]
    assert list(zip(document, place, every[which])) == plain


def test_few_anchors_share_their_bits_by_chance():
    text = np.random.default_rng(5).integers(32, 127, 2_000_000, dtype=np.uint8).tobytes()
    few, all_ = (len(ri._block_anchors(text, np.array([len(text)]), bits)[0]) for bits in (32, 64))
    assert all_ - few < 15
