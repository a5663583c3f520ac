"""Offset-preserving SentencePiece encoding and decoding.

The text is normalised as the model's compiled character map says: at each
position the longest prefix in the map's trie is replaced (or one character is
kept), white space becomes the word mark, and for every byte of the result the
source byte is recorded. Pieces lie end to end on the normalised text, so each
piece's bounds go through that record to a span of original UTF-8 bytes.

Ids come from the library. Where the vocabulary proves that no piece holds a
word mark behind another character, merges never cross the start of a run of
word marks; such a model's texts are cut there, and each distinct chunk is
encoded once per worker (bounded memory). Other models are encoded whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import memo
from .common import list_array, small_batches

MARK = "▁"
_MARK = MARK.encode()
#: A run of word marks and what follows up to the next mark.
_CHUNK = re.compile(rb"(?:\xe2\x96\x81)+(?:(?!\xe2\x96\x81).)*", re.DOTALL)
#: Chunks that a worker remembers (twice as many at most).
REMEMBERED = 150_000
SCHEMA = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string, spans_sha256 string"


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised protocol message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, message[at:at + size]
            at += size
        else:
            size = 8 if kind == 1 else 4
            yield key >> 3, message[at:at + size]
            at += size


class Normaliser:
    """Longest-prefix normalisation with source alignment. Field numbers and
    defaults are those of the public model format (normalizer_spec is field 3
    of the model; in it 2: map, 3: dummy prefix, 4: remove extra spaces, 5:
    escape spaces)."""

    def __init__(self, model: bytes):
        spec = dict(_fields(dict(_fields(model)).get(3, b"")))
        blob = spec.get(2, b"")
        self.dummy_prefix = bool(spec.get(3, 1))
        self.squeeze = bool(spec.get(4, 1))
        self.space = _MARK if spec.get(5, 1) else b" "
        self.units: np.ndarray | None = None
        self.strings = b""
        if blob:
            size, = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4)
            self.strings = blob[4 + size:]

    @property
    def plain(self) -> bool:
        """No map and no squeezing: only spaces change."""
        return self.units is None and not self.squeeze

    def longest(self, text: bytes, at: int) -> tuple[bytes, int]:
        """(replacement, source bytes used) at a character boundary."""
        best: tuple[int, int] | None = None
        if self.units is not None:
            units = self.units
            unit = int(units[0])
            node = (unit >> 10) << ((unit & 512) >> 6)
            for k in range(at, len(text)):
                byte = text[k]
                node ^= byte
                unit = int(units[node])
                if unit & 0x800000FF != byte:
                    break
                node ^= (unit >> 10) << ((unit & 512) >> 6)
                if unit & 256:
                    best = (int(units[node]) & 0x7FFFFFFF, k + 1 - at)
        if best:
            value, used = best
            return self.strings[value:self.strings.index(b"\0", value)], used
        first = text[at]
        used = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return text[at:at + used], used

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source byte of each of them and of the end)."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            return self._plain(text)
        out, source = bytearray(), []
        at, after_space = 0, self.squeeze
        while self.squeeze and at < len(text):
            part, used = self.longest(text, at)
            if part != b" ":
                break
            at += used
        if at == len(text):
            return b"", np.array([len(text)], np.int64)
        if self.dummy_prefix:
            out += self.space
            source += [at] * len(self.space)
        after_space = self.squeeze
        while at < len(text):
            part, used = self.longest(text, at)
            while after_space and part.startswith(b" "):
                part = part[1:]
            if part:
                for byte in part:
                    piece = self.space if byte == 0x20 else bytes([byte])
                    out += piece
                    source += [at] * len(piece)
                after_space = self.squeeze and part.endswith(b" ")
            at += used
        end = len(text)
        while self.squeeze and out.endswith(self.space):
            end = source[len(out) - len(self.space)]
            del source[len(out) - len(self.space):], out[len(out) - len(self.space):]
        return bytes(out), np.array([*source, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        lead = self.space if self.dummy_prefix else b""
        wide = len(self.space)
        width = np.ones(len(text), np.int8)
        if wide > 1:
            width[np.frombuffer(text, np.uint8) == 0x20] = wide
        source = np.concatenate([np.zeros(len(lead), np.int64),
                                 np.repeat(np.arange(len(text)), width), [len(text)]])
        return lead + text.replace(b" ", self.space), source


class Codec:
    """One model in one worker: encode with spans, decode."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = Normaliser(self.model.serialized_model_proto())
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        #: bytes of normalised text that a piece covers (a byte piece: one)
        self.width = np.array([1 if self.model.is_byte(i) else len(p.encode())
                               for i, p in enumerate(names)], np.int64)
        user = [p for i, p in enumerate(names) if not (
            self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        self.by_chunk = (self.normalise.plain and self.normalise.dummy_prefix
                         and self.normalise.space == _MARK
                         and all(self.model.is_byte(self.model.piece_to_id(f"<0x{b:02X}>"))
                                 for b in range(256))
                         and not any(MARK in p.lstrip(MARK) for p in user))
        self.memo = memo.Memo(self._new_chunks, REMEMBERED)

    def _new_chunks(self, chunks: list[bytes]) -> list[bytes]:
        texts = [c.decode().replace(MARK, " ") for c in chunks]
        return [np.array(ids, np.int32).tobytes() if text else self._mark_alone
                for text, ids in zip(texts, self.model.encode(texts, num_threads=1))]

    @property
    def _mark_alone(self) -> bytes:
        """Ids of a single word mark (an empty text would have no dummy prefix)."""
        return np.array([self.model.piece_to_id(MARK)], np.int32).tobytes()

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, bounds) of each text: piece k covers the original bytes from
        bounds[k] to bounds[k + 1]."""
        if not self.by_chunk:
            return [self._whole(t) for t in texts]
        normal = [self.normalise(t) for t in texts]
        chunks = []
        for norm, _ in normal:
            own = norm.split(_MARK)[1:]
            if b"" in own:
                own = [c[3:] for c in _CHUNK.findall(norm)]
            chunks.append(own)
        out = []
        for (norm, source), own in zip(normal, self.memo.values(chunks)):
            ids = np.frombuffer(b"".join(own), np.int32)
            out.append((ids, self._bounds(self.width[ids], norm, source)))
        return out

    def _whole(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        norm, source = self.normalise(text)
        made = self.model.encode(text.decode(), return_type="proto").pieces
        ids = np.array([p.id for p in made], np.int32)
        width = np.array([1 if self.model.is_byte(p.id) else len(p.piece.encode()) for p in made],
                         np.int64)
        return ids, self._bounds(width, norm, source)

    @staticmethod
    def _bounds(width: np.ndarray, norm: bytes, source: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(width)])
        if ends[-1] != len(norm):
            raise ValueError("the pieces do not cover the normalised text")
        return source[ends]


def spans_hash(bounds: np.ndarray) -> str:
    """Digest of where the pieces of a text begin and the last one ends, as
    little-endian 32-bit integers."""
    return hashlib.sha256(np.asarray(bounds).astype("<u4").tobytes()).hexdigest()


def _coder(path: str, end_id: int | None):
    def run(batches):
        codec = memo.held(("pieces", path), lambda: Codec(path))
        last = [] if end_id is None else [end_id]
        for batch in small_batches(batches, "text"):
            texts = [t.encode() if t is not None else b"" for t in batch.column("text").to_pylist()]
            ids, starts, ends, counts, spans = [], [], [], [], []
            for text, (own, bounds) in zip(texts, codec.encode(texts)):
                ids += [own, last]
                starts += [bounds[:-1], [len(text)] * len(last)]
                ends += [bounds[1:], [len(text)] * len(last)]
                counts.append(len(own) + len(last))
                spans.append(spans_hash(bounds))
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            cuts = np.cumsum([0, *counts])
            decoded = [codec.model.decode(flat[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), list_array(flat, counts, pa.int32()),
                 list_array(np.concatenate(starts).astype(np.int32), counts, pa.int32()),
                 list_array(np.concatenate(ends).astype(np.int32), counts, pa.int32()),
                 pa.array(decoded, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "ids", "starts", "ends", "decoded", "spans_sha256"])
    return run


def encode_decode(docs: DataFrame, model_path: str, end_id: int | None = 2) -> DataFrame:
    """doc_id, ids, starts, ends (original byte span of each piece; the end id
    spans nothing at the end), decoded, spans_sha256 (of the pieces' bounds
    without the end id, see ``spans_hash``), of every row of ``docs`` (doc_id, text).

    A null text is an empty text: only the end id. A null doc_id is kept.
    Repeated rows give repeated rows, an empty table an empty result; other
    columns are not read. ``model_path`` is the model's place on every worker.
    """
    return docs.select("doc_id", "text").mapInArrow(_coder(model_path, end_id), SCHEMA)
