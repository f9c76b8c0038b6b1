"""Ids, decoded texts and piece ends against the public library, for the given model and for compiled character maps."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_tables import SMALL, awkward, documents  # noqa: F401
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm import piece_encoding as pe

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "▁", "a", "b", "th", "ing", "\n", "\t", "\x00", "é", "é", "中文", "😀", "<s>", "</s>", "<unk>", "<0x41>"]
PARTS += ["1", "23", ".", ",", "\xa0", "　", "﻿", "ﬁ", "İ", "‍", "퟿", "\U0010ffff", "the", "\r\n", " of", "(", "?", "㎏", "ｶﾞ"]


def model(rule=None):
    """The bytes of the given model, with the character map of a public normalisation rule."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    if rule is not None:
        named = sentencepiece_model_pb2.ModelProto()
        named.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        proto.normalizer_spec.precompiled_charsmap = named.normalizer_spec.precompiled_charsmap
    return proto.SerializeToString()


def made_texts(count):
    pick = random.Random(3)
    texts = ["".join(pick.choices(PARTS, k=pick.randrange(14))) for _ in range(count)]
    return texts + ["".join(chr(pick.randrange(1, 0xD800)) for _ in range(30)) for _ in range(count // 10)]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf"])
def test_pieces_equal_the_library(rule):
    definition = model(rule)
    library = sentencepiece.SentencePieceProcessor(model_proto=definition)
    own = pe.PieceModel(definition)
    texts = made_texts(1_500)
    for text, pieces in zip(texts, own.pieces([t.encode() for t in texts])):
        ids = library.encode(text)
        assert pieces.ids.tolist() == ids
        assert pieces.decoded.decode() == library.decode(ids)
        assert pieces.ends.tolist() == [p.end for p in library.encode(text, return_type="proto").pieces]


def test_decoding_any_ids_equals_the_library():
    library, own, pick = sentencepiece.SentencePieceProcessor(model_file=PATH), pe.PieceModel(model()), random.Random(5)
    for _ in range(1_500):
        ids = [pick.choice([pick.randrange(3, 259), pick.randrange(32_000)]) for _ in range(pick.randrange(8))]
        assert own.decode(np.array(ids, np.int64)).decode() == library.decode(ids)


def test_what_is_remembered_changes_nothing(monkeypatch):
    texts = [t.encode() for t in made_texts(300)]
    want = [p.ids.tolist() for p in pe.PieceModel(model()).pieces(texts)]
    monkeypatch.setattr(pe, "REMEMBERED_SEGMENTS", 5)
    monkeypatch.setattr(pe, "REMEMBERED_BYTES", 3)
    forgetful = pe.PieceModel(model())
    assert [forgetful.pieces([t])[0].ids.tolist() for t in texts] == want


def test_long_texts_without_a_space(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["a" * 1_000_000, "".join(random.Random(1).choices("abcdefgh", k=300_000)), "x y " * 100_000]
    got = {r["doc_id"]: r["ids"] for r in pe.encoded(documents(texts), pe.model_definition(), "ids").collect()}
    assert got == {i: library.encode(t) for i, t in enumerate(texts)}


def test_spans_cover_the_text_and_pieces_decode(spark, documents):
    texts = made_texts(60)
    rows = pe.encoded(documents(texts), pe.model_definition(), "ids", "ends", "decoded")
    back = {r["doc_id"]: r["text"] for r in pe.decoded(rows, pe.model_definition()).collect()}
    for row in rows.collect():
        data = texts[row["doc_id"]].encode()
        assert row["ends"] == sorted(row["ends"]) and (row["ends"] or [0])[-1] == len(data)
        assert back[row["doc_id"]] == row["decoded"]


def test_query_over_whole_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = pe.piece_encoding(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_awkward_rows(spark, awkward, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = sorted(((r["doc_id"], library.encode(r["text"] or "")) for r in awkward.collect()), key=repr)
    got = sorted(((r["doc_id"], r["ids"]) for r in pe.encoded(awkward, pe.model_definition(), "ids").collect()), key=repr)
    assert got == want
    assert pe.encoded(documents([]), pe.model_definition(), "n_tokens", "ids_sha256").collect() == []
    assert pe.decoded(pe.encoded(documents([None]), pe.model_definition(), "ids"), pe.model_definition()).first()["text"] == ""


def test_other_kinds_of_models_are_refused():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pe.PieceModel(proto.SerializeToString())
    proto.normalizer_spec.remove_extra_whitespaces = False
    proto.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        pe.PieceModel(proto.SerializeToString())
