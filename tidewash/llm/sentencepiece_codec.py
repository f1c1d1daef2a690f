"""Operator 5, SentencePiece encoding and decoding on the tokenizers library.

The model file is read as protobuf wire data; from it the normaliser (character map,
extra spaces, dummy prefix, space marker), the model (unigram scores, or byte-pair
merges in the order of the pieces' scores), byte fallback and the decoder are rebuilt
with the tokenizers library.

Texts are cut into chunks, each a run of space markers and what follows up to the next
marker.  No piece holds a marker after another character (checked when the model is
read; otherwise a whole text is one chunk), so no merge crosses a chunk's border and
the ids of a text are those of its chunks in order.  A worker encodes each new chunk
once, in multithreaded batches, and verifies it there against the sentencepiece
library (parity).  Should a chunk differ, the reference's ids are taken and ``parity``
is false for its texts, so ids are always those of the model.  Every text's ids are then
decoded as a whole: ``round_trip`` tells whether that is the text as normalised,
``literal`` whether it is the text itself.

Known chunks are kept in two generations of bounded bytes: when the younger is full it
becomes the older, and chunks that are met again move up, so frequent ones stay.  Long
chunks (whole texts of unspaced scripts) are not kept.  The next operator's tasks drop all of it.

Defined cases: null and empty texts have no ids and decode to the empty text; a literal
U+2581 reads as a space, as in the reference (``literal`` is then false); other columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import contextlib
import functools
import gc
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import frees, holds, sliced

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of chunks that a worker keeps in each of two generations, with what a dict entry takes.
CACHE_BYTES = 40 << 20
ENTRY_BYTES = 200
#: Longer chunks are not kept.
LONG_CHUNK = 64
#: Threads of a task's encoder.
THREADS = 2

NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of every field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        elif kind == 5:
            value, at = data[at:at + 4], at + 4
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield tag >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    suffix_marker: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                m.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                m.kind, m.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
                m.unk_id, m.suffix_marker = spec.get(40, 0), bool(spec.get(24, 0))
            elif number == 3:
                spec = dict(_fields(value))
                m.charsmap, m.dummy_prefix = spec.get(2, b""), bool(spec.get(3, 1))
                m.remove_extra_spaces, m.escape_spaces = bool(spec.get(4, 1)), bool(spec.get(5, 1))
        if m.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {m.kind}: only unigram (1) and byte-pair (2) models are supported")
        if m.suffix_marker or not m.escape_spaces:
            raise ValueError("models with a suffix marker or unescaped spaces are not supported")
        return m

    def splittable(self) -> bool:
        """True if no piece has a marker after another character."""
        return not any(MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind in (NORMAL, USER_DEFINED, UNUSED))

    def merges(self) -> list[tuple[str, str]]:
        """All ways to put a piece together from two others, best piece first; equal
        scores keep the order of ids."""
        ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
        out = []
        for piece, i in ids.items():
            ways = [(piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
            out += [(-self.pieces[i][1], i, ids[a], ids[b], a, b) for a, b in ways]
        return [(a, b) for *_, a, b in sorted(out)]


def build(model: Model, whole: bool = True):
    """The tokenizer of whole texts, or that of chunks."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    def core():
        if model.kind == UNIGRAM:
            return models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
        return models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, model.merges(),
                          unk_token=model.pieces[model.unk_id][0], fuse_unk=True, byte_fallback=model.byte_fallback)

    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    out = Tokenizer(core())
    if whole:
        out.normalizer = normalizers.Sequence(steps)
        if model.splittable():
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if whole and model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return out


class Codec:
    """Encodes and decodes with one model; keeps the chunks it has seen."""

    def __init__(self, data: bytes, threads: int = THREADS, cache_bytes: int = CACHE_BYTES) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        import sentencepiece

        self.model = Model.parse(data)
        self.chunk = build(self.model, whole=False)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.plain = not self.model.charsmap and not self.model.remove_extra_spaces
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+") if self.model.splittable() else None
        self.limit = cache_bytes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.differs: set[str] = set()
        self.bytes_of = [self._piece_bytes(p, kind) for p, _, kind in self.model.pieces]

    @functools.cached_property
    def whole(self):
        """The tokenizer of whole texts."""
        return build(self.model)

    @staticmethod
    def _piece_bytes(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(MARK, " ").encode()

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if self.plain:
            text = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        else:
            text = self.whole.normalizer.normalize_str(text)
        return self.cut.findall(text) if self.cut else [text] if text else []

    def learn(self, new: list[str]) -> list[bytes]:
        """Encode chunks in one multithreaded batch, each by both libraries."""
        prefix, out, add = self.model.dummy_prefix, [], self.differs.add
        expected = self.reference.encode([c[1:].replace(MARK, " ") if prefix else c.replace(MARK, " ") for c in new])
        for c, found, want in zip(new, self.chunk.encode_batch_fast(new, add_special_tokens=False), expected):
            ids = found.ids
            # The reference has no ids for the empty text, whose chunk would be the lone marker.
            if ids != want and not (prefix and c == MARK):
                add(c)
                ids = want
            out.append(array("i", ids).tobytes())
        return out

    def _keep(self, chunks: list[str], here: dict[str, bytes]) -> None:
        """Into the younger generation; a full one becomes the older."""
        kept = [c for c in chunks if len(c) <= LONG_CHUNK]
        step = 1 << 10
        for some in (kept[at:at + step] for at in range(0, len(kept), step)):
            ids = [here[c] for c in some]
            self.young.update(zip(some, ids))
            self.held += ENTRY_BYTES * len(some) + sum(map(len, some)) + sum(map(len, ids))
            if self.held > self.limit:
                self.old, self.young, self.held = self.young, {}, 0
        if self.differs:
            self.differs = {c for c in self.differs if c in self.young or c in self.old}

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as little-endian 32-bit bytes, parity) of each text."""
        cut = [self.chunks(t or "") for t in texts]
        here: dict[str, bytes] = {}
        new, met = [], []
        young, old = self.young.get, self.old.get
        for c in set().union(*cut):
            ids = young(c)
            if ids is None:
                ids = old(c)
                if ids is None:
                    new.append(c)
                    continue
                met.append(c)
            here[c] = ids
        for at in range(0, len(new), 1 << 15):
            some = new[at:at + (1 << 15)]
            here.update(zip(some, self.learn(some)))
        get, differs = here.__getitem__, self.differs
        out = [(b"".join(map(get, c)), differs.isdisjoint(c) if differs else True) for c in cut]
        self._keep(met, here)
        self._keep(new, here)
        return out

    def read_back(self, text: str | None, ids: bytes) -> tuple[bool, bool]:
        """(round trip, literal): whether the ids decode to the text as the model's normaliser
        leaves it, and to the text itself."""
        data = self.text_bytes(np.frombuffer(ids, "<i4").tolist())
        if data == (text or "").encode():
            return True, True
        normal = "".join(self.chunks(text or "")).replace(MARK, " ")
        return data == (normal[1:] if self.model.dummy_prefix else normal).encode(), False

    def text_bytes(self, ids: list[int]) -> bytes:
        """The bytes of ids: those of the pieces joined, less the dummy prefix's space."""
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        return data[1:] if self.model.dummy_prefix and data[:1] == b" " else data

    def decode(self, ids: list[int]) -> str:
        return self.text_bytes(ids).decode("utf-8", "replace")


_CODECS: dict[int, Codec] = {}


def _codec(data: bytes, threads: int) -> Codec:
    """One codec in a worker, however many batches and tasks it gets."""
    key = hash(data)
    if key not in _CODECS:
        _CODECS[key] = Codec(data, threads)
    holds(__name__, _CODECS.clear)
    return _CODECS[key]


@contextlib.contextmanager
def _no_cycles() -> Iterator[None]:
    """Without the collector of reference cycles: millions of strings, and no cycle, to look at."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


@frees
def _encoded(batches: Iterator[pa.RecordBatch], data: bytes, threads: int) -> Iterator[pa.RecordBatch]:
    codec = _codec(data, threads)
    for batch in sliced(batches, "text", 1 << 20):
        texts = batch.column("text").to_pylist()
        with _no_cycles():
            found = codec.encode(texts)
            back = [codec.read_back(t, x) for t, (x, _) in zip(texts, found)]
        ids = np.frombuffer(b"".join(x for x, _ in found), "<i4")
        sizes = [len(x) // 4 for x, _ in found]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids)),
             pa.array([p for _, p in found], pa.bool_()), pa.array([r for r, _ in back], pa.bool_()),
             pa.array([x for _, x in back], pa.bool_())],
            [*(c for c in batch.schema.names if c != "text"), "n_tokens", "ids", "parity", "round_trip", "literal"])


@frees
def _decoded(batches: Iterator[pa.RecordBatch], data: bytes, threads: int) -> Iterator[pa.RecordBatch]:
    codec = _codec(data, threads)
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([codec.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())],
            ["id", "text"])


def _model_bytes(path: str) -> bytes:
    """A model file is small (half a megabyte here) and goes to the tasks as bytes."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str, text_col: str, model_path: str = MODEL_PATH,
           threads: int = THREADS) -> DataFrame:
    """id, n_tokens, ids (array of int), parity, round_trip, literal per row of ``docs``."""
    data = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _encoded(b, data.value, threads),
                           "id long, n_tokens long, ids array<int>, parity boolean, round_trip boolean, literal boolean")


def decode(encoded: DataFrame, id_col: str, ids_col: str, model_path: str = MODEL_PATH) -> DataFrame:
    """id, text per row of ``encoded``."""
    data = encoded.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(lambda b: _decoded(b, data.value, THREADS), "id long, text string")
