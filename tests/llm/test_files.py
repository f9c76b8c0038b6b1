"""Archives, packing, nearest neighbours and the pipeline: round trips and invariants."""

import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from llm_tables import SMALL, awkward, documents  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import learned_partitions as lp
from tidemark.llm import packing_histogram as ph
from tidemark.llm import warc


def pages(spark, htmls, ids=None):
    ids = range(len(htmls)) if ids is None else ids
    rows = [(i, f"http://x/{k}\n" if k % 2 else None, h, "extra") for k, (i, h) in enumerate(zip(ids, htmls))]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, payload string")


def round_trip(spark, rows, path):
    warc.write_archives(warc.with_revisits(rows), str(path))
    return warc.read_archives(spark, str(path)).collect()


def test_archives_round_trip(spark, tmp_path):
    htmls = ["<p>é</p>" * 30] * 3 + ["short"] * 2 + [None, "", "y" * 300_000, "\x00퟿" * 90]
    rows = round_trip(spark, pages(spark, htmls, [3, 1, 2, 4, 5, 6, None, 8, 9]), tmp_path / "w")
    assert all(r.error is None for r in rows) and len(rows) == len(htmls)
    by_id = {r.record_id: r for r in rows}
    assert [(by_id[i].record_type, by_id[i].refers_to) for i in "123"] == [("response", None), ("revisit", "1"), ("revisit", "1")]
    assert bytes(by_id["1"].payload).decode() == htmls[0] and by_id["2"].payload is None
    assert by_id["2"].payload_bytes == len(htmls[0].encode()) and by_id["2"].payload_digest == by_id["1"].payload_digest
    assert by_id["4"].record_type == by_id["5"].record_type == "response"
    assert bytes(by_id["8"].payload) == htmls[7].encode() and by_id["6"].payload_bytes == 0


def test_other_readers_can_decode_an_archive(spark, tmp_path):
    warc.write_archives(warc.with_revisits(pages(spark, ["z" * 500])).coalesce(1), str(tmp_path / "w"))
    (file,) = (f for f in (tmp_path / "w").glob("part-*") if f.stat().st_size)
    data = file.read_bytes()
    size = int.from_bytes(data[4:8], "little")
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    with reader.stream_reader(data[8 + size :], read_across_frames=True) as stream:
        assert stream.read().startswith(b"WARC/1.1\r\n")


def test_damaged_archives_say_so(spark, tmp_path):
    rows = pages(spark, [f"page {i} " * 200 for i in range(20)]).coalesce(1)
    warc.write_archives(warc.with_revisits(rows).coalesce(1), str(tmp_path / "w"))
    (file,) = (f for f in (tmp_path / "w").glob("part-*") if f.stat().st_size)
    data = file.read_bytes()
    for name, bad in (("cut", data[:-20]), ("odd", data[:-400] + b"?" + data[-399:])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc.zst").write_bytes(bad)
        assert any(r.error for r in warc.read_archives(spark, str(tmp_path / name)).collect())
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")


def test_empty_pages(spark, tmp_path):
    assert round_trip(spark, pages(spark, []), tmp_path / "w") == []


# --------------------------------------------------------------------------- packing


def check_packing(rows, texts):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_str(ph.tokenizer_definition())
    wanted, got = Counter(), Counter()
    for text in texts:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), 4096):
            piece = np.array(ids[at : at + 4096], "<u4")
            wanted[at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    sequences = {}
    for r in rows:
        got[r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return sequences


def test_packing_keeps_every_token(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sequences = check_packing(ph.pack(docs, ph.tokenizer_definition()).collect(), [r.text for r in docs.select("text").collect()])
    used = sum(length for parts in sequences.values() for _, length in parts)
    assert used / (4096 * len(sequences)) > 0.95


def test_words_are_looked_up_once_and_encoded_as_the_tokenizer_does(monkeypatch):
    class Counted(dict):
        looks = 0

        def get(self, *key):
            self.looks += 1
            return super().get(*key)

    encoder = ph.WordIds(ph.tokenizer_definition())
    odd = ["", " ", "\x0b a\x0c\r\n b ", "it's don't. x., 12,345.", "a<|endoftext|>b <|endoftext|> <|ENDOFTEXT|>", "e\u0301 \u0301e \u00e9", "a\u00a0b \u2003c", "naïve Ünï. 你好, 🙂🙂 \x00\x1c", "- -- --- 7-8 x_y"]
    odd += [" ".join(odd * 20), "\u0130 \u1e9e \ufb01 A\u030a"]
    texts = [text.encode() for text in odd]
    want = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in odd]
    for most in (ph.REMEMBERED_WORDS, 1, 1):  # also when all has to be remembered anew
        monkeypatch.setattr(ph, "REMEMBERED_WORDS", most)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == want
    assert [part for some in ph._in_parts(texts) for part in some] == texts and list(ph._in_parts([])) == []
    monkeypatch.setattr(ph, "BYTES_AT_ONCE", 10)
    assert [part for some in ph._in_parts(texts) for part in some] == texts
    monkeypatch.setattr(ph, "REMEMBERED_WORDS", 10**6)
    encoder.recent = Counted(encoder.recent)
    list(encoder.encode([b"word other " * 1_000] * 10))
    assert encoder.recent.looks < 10


def test_awkward_rows_packing(awkward, documents):  # noqa: F811
    check_packing(ph.pack(awkward, ph.tokenizer_definition()).collect(), [r.text for r in awkward.select("text").collect()])
    assert ph.pack(documents([]), ph.tokenizer_definition()).count() == 0
    ids = ph.pack(documents(["a b", "<|endoftext|> A."]), ph.tokenizer_definition(), ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in ids)


@pytest.mark.parametrize("histogram", [{4096: 3}, {1: 10_000}, {4000: 5, 96: 3, 10: 7}, {i: i % 7 for i in range(1, 4097)}, {}])
def test_patterns_use_up_the_histogram(histogram):
    patterns = ph.pack_histogram(histogram)
    used = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 4096
        for length in lengths:
            used[length] += count
    assert used == Counter({k: v for k, v in histogram.items() if v})
    if histogram:
        total = sum(k * v for k, v in histogram.items())
        assert sum(c for c, _ in patterns) <= total / 4096 * 1.6 + 1


def test_ranks_do_not_depend_on_buckets(spark):
    rows = spark.range(500).select(F.col("id").alias("row"), (F.col("id") % 3 == 0).cast("bigint").alias("length"))
    for size in (7, 1_000):
        found = ph.ranked(rows, "length", size).collect()
        for length, count in ((0, 333), (1, 167)):
            assert sorted(r["rank"] for r in found if r.length == length) == list(range(count))


# --------------------------------------------------------------------------- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, part string")


def brute(ids, x, asked, k=5):
    unit = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    out = {}
    for q in asked:
        score = np.round(unit @ unit[ids.index(q)], 12)
        order = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-score[i], ids[i]))
        out[q] = [ids[i] for i in order[:k]]
    return out


def test_recall_against_brute_force(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(0, 1, (20, 16))
    x = (centres[draw.integers(0, 20, 6_000)] + draw.normal(0, 0.4, (6_000, 16))).astype(np.float32)
    rows = [(i, v.tolist(), "") for i, v in enumerate(x)]
    found = lp.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()
    wanted = brute(list(range(6_000)), x.astype(float), range(0, 6_000, 50))
    hits = sum(r.vec_id in wanted[r.query_id] for r in found)
    assert len(found) == 5 * 120 and hits / len(found) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], ""), (50, [1.0, 0.0], ""), (7, [1.0, 0.0], ""), (8, [2.0, 0.1], ""), (7, [1.0, 0.0], "")]
    rows += [(9, [0.0, 0.0], ""), (10, None, ""), (11, [nan, 1.0], ""), (12, [inf, 1.0], ""), (13, [None, 1.0], ""), (None, [1.0, 1.0], "")]
    rows += [(100, [1.0, 2.0, 3.0], ""), (150, [], "")]
    found = {}
    for r in lp.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {0: [7, 50, 8], 50: [0, 7, 8]}
    assert lp.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [0.3, 0.7], "") for i in range(3_000)] + [(i, [1.0, float(i)], "") for i in range(3_000, 3_100)]
    found = lp.nearest(vectors(spark, rows), F.col("vec_id").isin(0, 2_950)).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in found] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4] and len({r.score for r in found}) == 1


def test_parts_are_balanced():
    x = lp._unit(np.random.default_rng(0).normal(0, 1, (512, 8)))
    label = lp.balanced_parts(x, lp.neighbour_graph(x, 10), 8)
    assert np.bincount(label).tolist() == [64] * 8


# --------------------------------------------------------------------------- the pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SMALL)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3]


def test_pipeline_of_no_documents(spark, documents):  # noqa: F811
    docs = documents([]).select(*corpus_pipeline.COLUMNS)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
    assert docs.count() == 0


def test_pipeline_of_awkward_rows(spark, awkward):  # noqa: F811
    docs = awkward
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
    assert docs.count() > 0
