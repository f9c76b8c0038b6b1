"""Encoding with a byte-pair piece model, with the byte span of the original text behind every piece, and decoding.

A text is normalised first. At each place the longest prefix that the model's compiled character map knows is replaced, all
other characters stay; a space is set in front, where the model wants one. Normalisation records which original byte each
normalised byte comes from. The pieces cover the normalised text, so the ends of pieces there, looked up in that record, are
ends of spans of original bytes.

No piece holds a space behind another character (models that have one are refused), so nothing is merged from a character
into the spaces after it. The normalised text is cut there, and at other places that no piece reaches across, into segments
that are searched for pieces by themselves. A task searches the new segments of many texts together and remembers their ids
in a table of bounded size; a text is the joined ids of its segments, encoded whole, however long.

Decoding joins the texts of the pieces, with runs of byte pieces read as UTF-8, and drops the leading space.

Defined cases: a null text is empty and has no pieces; control pieces written out in a text are ordinary text; bytes that
are not UTF-8 are read as U+FFFD; repeated rows and null ids are encoded like any other; an empty table gives no rows; extra
columns are ignored. A model that is not byte-pair with byte fallback, drops white space or has pieces of a user's own is
refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.registry import query, table

MARK = "▁"
MARK_BYTES = MARK.encode()
#: Segments whose ids a task remembers; beyond, it starts anew.
REMEMBERED_SEGMENTS = 400_000
#: Longer segments are not remembered.
REMEMBERED_BYTES = 64
#: Texts whose new segments are searched together: so many, or so many bytes.
TEXTS_AT_ONCE, BYTES_AT_ONCE = 256, 1_000_000


# --------------------------------------------------------------------------- normalisation

class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8, whose values are places of zero-ended replacements."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size :]

    @cached_property
    def first_bytes(self) -> frozenset[int]:
        """Bytes that a replaced prefix can begin with."""
        return frozenset(b for b in range(256) if self.units and self._step(self._below(0), b) is not None)

    def _below(self, at: int) -> int:
        unit = self.units[at]
        return at ^ (unit >> 10) << ((unit >> 9 & 1) << 3)

    def _step(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def longest(self, data: bytes, start: int) -> tuple[int, bytes] | None:
        """(end, replacement) of the longest known prefix of ``data`` from ``start``."""
        if not self.units:
            return None
        found, base = None, self._below(0)
        for i in range(start, len(data)):
            at = self._step(base, data[i])
            if at is None:
                break
            base = self._below(at)
            if self.units[at] >> 8 & 1:  # a value hangs below
                found = (i + 1, self.units[base] & 0x7FFFFFFF)
        if found is None:
            return None
        end, place = found
        return end, self.replacements[place : self.replacements.index(b"\0", place)]


@dataclass(frozen=True)
class Normalised:
    """A normalised text, and for each of its bytes and its end the original byte; None: the bytes themselves."""

    data: bytes
    source: np.ndarray | None


class Rules:
    """How a model normalises. Marks that are written in a text are read as spaces once all else is done."""

    def __init__(self, compiled: bytes, leading_space: bool) -> None:
        self.characters, self.leading_space = CharacterMap(compiled), leading_space
        first = self.characters.first_bytes
        self.replaceable = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in sorted(first)) + b"]") if first else None

    def normalise(self, text: bytes) -> Normalised:
        if MARK_BYTES not in text and (self.replaceable is None or not self.replaceable.search(text)):
            data, source = text, None
        else:
            data, source = _without_marks(*self._replaced(text))
        if data and self.leading_space:
            data = b" " + data
            source = None if source is None else np.concatenate([source[:1], source])
        return Normalised(data, source)

    def _replaced(self, text: bytes) -> tuple[bytes, np.ndarray]:
        out, source, done, at = [], [], 0, 0
        while self.replaceable and (found := self.replaceable.search(text, at)):
            start = found.start()
            known = self.characters.longest(text, start)
            at = start + 1 if known is None else known[0]
            if known is not None:
                out += [text[done:start], known[1]]
                source += [np.arange(done, start), np.full(len(known[1]), start)]
                done = at
        out.append(text[done:])
        source.append(np.arange(done, len(text) + 1))
        return b"".join(out), np.concatenate(source)


def _without_marks(data: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
    """With a space for every mark."""
    bytes_of = np.frombuffer(data, np.uint8).copy()
    keep = np.ones(len(data) + 1, bool)
    for found in re.finditer(MARK_BYTES, data):
        bytes_of[found.start()] = 0x20
        keep[found.start() + 1 : found.end()] = False
    return bytes_of[keep[:-1]].tobytes(), source[keep]


# --------------------------------------------------------------------------- pieces


class Spelling:
    """Joins the entries of a table of byte strings."""

    def __init__(self, entries: list[bytes]) -> None:
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        places = np.repeat(self.starts[ids] - before, sizes)
        return self.data[places + np.arange(len(places))].tobytes()


class PieceModel:
    """A model and the segments that were searched lately."""

    def __init__(self, serialised: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(serialised)
        normal, unknown, own, unused, byte = 1, 2, 4, 5, 6
        kinds, spec = {p.type for p in proto.pieces}, proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or kinds & {own, unused} or byte not in kinds:
            raise ValueError("only byte-pair models with byte fallback and without pieces of a user's own")
        if spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that keep all white space and mark it")
        self.rules = Rules(spec.precompiled_charsmap, spec.add_dummy_prefix)
        spec.precompiled_charsmap, spec.add_dummy_prefix = b"", False
        self.search = SentencePieceProcessor(model_proto=proto.SerializeToString())  # takes a text as it is
        self.segments = _segment_pattern([p.piece for p in proto.pieces if p.type == normal])
        texts = {
            normal: lambda p: p.piece.replace(MARK, " ").encode(),
            unknown: lambda p: proto.trainer_spec.unk_surface.encode(),
            byte: lambda p: bytes([int(p.piece[3:5], 16)]),
        }
        entries = [texts[p.type](p) if p.type in texts else b"" for p in proto.pieces]
        self.is_byte = np.array([p.type == byte for p in proto.pieces])
        self.texts, self.decimals = Spelling(entries), Spelling([b"%d," % i for i in range(len(entries))])
        self.known: dict[bytes, bytes] = {}

    def pieces(self, texts: list[bytes]) -> list[Pieces]:
        """The pieces of each text; new segments of all of them are searched together."""
        normal = [self.rules.normalise(text) for text in texts]
        split = [self.segments.findall(n.data) for n in normal]
        if len(self.known) > REMEMBERED_SEGMENTS:
            self.known.clear()
        known, passing = self.known, {}
        new = list(set().union(*split).difference(known))
        for part, ids in zip(new, self.search.encode([s.decode("utf-8", "replace") for s in new])):
            (known if len(part) <= REMEMBERED_BYTES else passing)[part] = np.array(ids, "<i4").tobytes()
        if passing:
            known = {part: known.get(part) or passing[part] for part in set().union(*split)}
        joined = (b"".join(map(known.__getitem__, parts)) for parts in split)
        return [Pieces(self, np.frombuffer(ids, "<i4"), n) for ids, n in zip(joined, normal)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of all ids of a text."""
        text = self.texts.of(ids)
        try:
            text.decode()
        except UnicodeDecodeError:
            text = self._repaired(ids)
        leading = self.rules.leading_space and text[:1] == b" " and not self.is_byte[ids[0]]
        return text[1:] if leading else text

    def _repaired(self, ids: np.ndarray) -> bytes:
        """With U+FFFD for every byte of a run of byte pieces that belongs to no UTF-8 character."""
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        runs = (self.texts.of(part) for part in np.split(ids, edges))
        return b"".join(map(_valid, runs))


def _valid(run: bytes) -> bytes:
    out = []
    while True:
        try:
            run.decode()
            return b"".join([*out, run])
        except UnicodeDecodeError as bad:
            out += [run[: bad.start], b"\xef\xbf\xbd"]
            run = run[bad.start + 1 :]


def _segment_pattern(pieces: Iterable[str]) -> re.Pattern:
    """What cuts a normalised text where no piece reaches across.

    A cut is made before spaces, and between a letter or digit and a punctuation character that follows none in any piece.
    """
    pieces = list(pieces)
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        raise ValueError("a piece holds a mark behind another character")
    joined = {b for piece in pieces for a, b in zip(piece, piece[1:]) if a != MARK and (a.isalnum() or not a.isascii())}
    apart = "".join(re.escape(c) for c in ".,;:!?()\"" if c not in joined)
    return re.compile(rf" *[0-9A-Za-z\x80-\xff]++(?=[ {apart}]|\Z)| *[^ ]+| +".encode("ascii"))


@dataclass(frozen=True)
class Pieces:
    """The ids of a text and where its pieces end."""

    model: PieceModel
    ids: np.ndarray
    normal: Normalised

    @property
    def ends(self) -> np.ndarray:
        """Where each piece ends in the bytes of the original text; it begins where the one before ends.

        Of the byte pieces of one character, the last one ends where the character does.
        """
        ids, model = self.ids, self.model
        ends = np.cumsum(model.texts.sizes[ids])
        ends = self._of_whole_characters(ends) if model.is_byte[ids].any() else ends
        if self.normal.source is not None:
            return self.normal.source[ends]
        return ends - 1 if model.rules.leading_space and len(ends) else ends

    def _of_whole_characters(self, ends: np.ndarray) -> np.ndarray:
        """Ends inside of a character are moved back to its beginning."""
        data = np.frombuffer(self.normal.data + b" ", np.uint8)
        inside = data[ends] & 0xC0 == 0x80
        begins = np.maximum.accumulate(np.where(data & 0xC0 != 0x80, np.arange(len(data)), 0))
        return np.where(inside, begins[ends], ends)

    @property
    def decoded(self) -> bytes:
        return self.model.decode(self.ids)


def model_definition(path: str | None = None) -> bytes:
    """The bytes of a model file, read once by the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


# --------------------------------------------------------------------------- tables

#: What can be asked of the pieces of a text.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda p: p.ids),
    "ends": ("array<bigint>", pa.list_(pa.int64()), lambda p: p.ends),
    "decoded": ("string", pa.string(), lambda p: p.decoded.decode()),
    "n_tokens": ("bigint", pa.int64(), lambda p: len(p.ids)),
    "ids_sha256": ("string", pa.string(), lambda p: hashlib.sha256(p.model.decimals.of(p.ids)[:-1]).hexdigest()),
    "decoded_sha256": ("string", pa.string(), lambda p: hashlib.sha256(p.decoded).hexdigest()),
    "ends_sha256": ("string", pa.string(), lambda p: hashlib.sha256(p.ends.astype("<i8").data).hexdigest()),
}


def _together(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if len(held) == TEXTS_AT_ONCE or size >= BYTES_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, definition: bytes, *outputs: str) -> DataFrame:
    """doc_id and the named ``OUTPUTS`` of each text.

    ``ids`` are its pieces and ``ends`` the original bytes at which they end; ``decoded`` is the text of the ids. Digests are
    of ids as decimals joined by commas, of the decoded UTF-8, and of ends as little-endian 64-bit integers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(shared.value)
        for batch in batches:
            at = 0
            for texts in _together(t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)):
                found = model.pieces(texts)
                made = [pa.array([OUTPUTS[name][2](p) for p in found], OUTPUTS[name][1]) for name in outputs]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *made], names=["doc_id", *outputs])
                at += len(texts)

    schema = ", ".join([f"doc_id {docs.schema['doc_id'].dataType.simpleString()}", *(f"{n} {OUTPUTS[n][0]}" for n in outputs)])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decoded(rows: DataFrame, definition: bytes) -> DataFrame:
    """doc_id and the text of ``ids``, of which null is none."""
    shared = rows.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(shared.value)
        for batch in batches:
            texts = [model.decode(np.array(ids.as_py() or [], np.int64)).decode() for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string"
    return rows.select("doc_id", "ids").mapInArrow(run, schema)


@query("op12_piece_encoding")
def piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole document encoded and decoded: the number of ids and digests of ids, decoded text and piece ends."""
    docs = table(spark, folder, "documents")
    return encoded(docs, model_definition(), "n_tokens", "ids_sha256", "decoded_sha256", "ends_sha256")
