"""Flat token files: unsigned ids, 64-bit document offsets, memory-mapped reads.

A table becomes ``shards`` files in ascending doc_id order (ranges of about
equal row count). Shard k holds, under the output folder,

* ``tokens-k.bin``: ids of its documents end to end, little-endian, 16 bits
  wide when the vocabulary allows and else 32;
* ``tokens-k.idx``: one little-endian 64-bit offset per document and one for
  the end, counted in ids over the *whole* table;
* ``tokens-k.doc``: the 64-bit doc_id of each document (null: the smallest
  64-bit integer).

A first pass writes the ids and each shard's document and id counts; prefix
sums over the counts give every shard's base; a second pass writes offsets with
the base added. A task writes under a name of its own and renames when done, so
a retried or speculative task leaves whole files only. The folder may be local
to a shared mount or any store that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import memo
from .common import small_batches, staged

#: Words that a worker remembers (twice as many at most).
REMEMBERED = 500_000
NO_ID = -(1 << 63)
#: Words sent to the tokenizer in one call.
_TOGETHER = 256
_SIGNS = [bytes([c]) for c in b".,;:!?"]
_SIGN_CODES = frozenset(b".,;:!?")


class WordTokenizer:
    """A tokenizer whose white space is dropped before its merges: a text's ids
    are those of its ASCII-space-separated words, one after the other, so each
    distinct word is encoded once per worker (bounded memory). The constructor
    checks the file's declared pipeline; other tokenizers get whole texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        import json

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _drops_space(spec)
        self.last = _last_of_word(spec, self.tokenizer.get_vocab_size()) if self.by_word else None
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.signs = {s: self._pack(self.tokenizer.encode(s.decode(), add_special_tokens=False).ids)
                      for s in [b"", *_SIGNS]}
        self.stems = memo.Memo(self._new_stems, REMEMBERED)
        self.memo = memo.Memo(self._new_words, REMEMBERED)

    def _pack(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _new_words(self, words: list[bytes]) -> list[bytes]:
        """A word's ids do not depend on the case of ASCII letters, and one
        ASCII sign behind a letter or digit is split off before the merges, so
        such words are looked up by their lower-cased stem."""
        stems = [word if b"<|" in word else word.lower() for word in words]
        signed = [i for i, low in enumerate(stems)
                  if low[-1] in _SIGN_CODES and low[-2:-1].isalnum() and b"<|" not in low]
        ends = [stems[i][-1:] for i in signed]
        for i in signed:
            stems[i] = stems[i][:-1]
        ids = self.stems.values([stems])[0]
        for i, end in zip(signed, ends):
            ids[i] += self.signs[end]
        return ids

    def _new_stems(self, words: list[bytes]) -> list[bytes]:
        """Words of ASCII letters are told apart by the token that ends each of
        them, all others by ``_by_offsets``."""
        if self.last is None:
            return self._by_offsets(words)
        plain, other = [], []
        for word in words:
            (plain if word.isalpha() else other).append(word)
        out = dict(zip(other, self._by_offsets(other)))
        for at in range(0, len(plain), _TOGETHER):
            group = plain[at:at + _TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(group).decode()],
                                                            add_special_tokens=False)[0].ids, np.int64)
            cuts = np.flatnonzero(self.last[ids]) + 1
            out.update(zip(group, self._cut(ids, np.concatenate([[0], cuts])) if len(cuts) == len(group)
                           else self._by_offsets(group)))
        return [out[word] for word in words]

    def _by_offsets(self, words: list[bytes]) -> list[bytes]:
        """Many words go into one call and are told apart by the tokens'
        offsets, where the normalisers keep every character in its place; else
        the library is told where each word ends."""
        out = []
        for at in range(0, len(words), _TOGETHER):
            group = words[at:at + _TOGETHER]
            text = b" ".join(group).decode()
            if text.isascii() and text.isprintable() and "<|" not in text:
                begin = np.cumsum([0, *[len(w) + 1 for w in group]])
            elif text.isprintable() and "<|" not in text and len(text.lower()) == len(text) \
                    and unicodedata.is_normalized("NFC", text):
                begin = np.cumsum([0, *[len(w) + 1 for w in text.split(" ")]])
            else:
                made = self.tokenizer.encode([w.decode() for w in group], is_pretokenized=True,
                                             add_special_tokens=False)
                of = np.array(made.word_ids, np.int64)
                out += self._cut(made.ids, np.searchsorted(of, np.arange(len(group) + 1)))
                continue
            made = self.tokenizer.encode(text, add_special_tokens=False)
            out += self._cut(made.ids, np.searchsorted(np.array([a for a, _ in made.offsets], np.int64), begin))
        return out

    def _cut(self, ids, cuts: np.ndarray) -> list[bytes]:
        raw, size = self._pack(ids), self.dtype.itemsize
        at = (cuts * size).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each text."""
        if not self.by_word:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(
                [t.decode() for t in texts], add_special_tokens=False)]
        return [b"".join(ids) for ids in self.memo.values([t.split() for t in texts])]


def _drops_space(spec: dict) -> bool:
    """Whether merges and normalisers can never see two words at once: splits
    keep matches only, matches hold no white space, no added token spans or
    strips space, and no step adds a prefix to the text."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = steps[0] if steps else {}
    pattern = (split.get("pattern") or {}).get("Regex", "")
    normal = {n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    return (split.get("type") == "Split" and split.get("behavior") == "Removed"
            and bool(split.get("invert")) and r"[^\s\p{L}\p{N}]+" in pattern
            and normal <= {"NFC", "Replace", "Lowercase"}
            and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"]
                        for t in spec.get("added_tokens", []))
            and not any(s.get("add_prefix_space") for s in steps))


def _last_of_word(spec: dict, size: int) -> np.ndarray | None:
    """Whether each id ends a word, if a run of ASCII letters is always one match
    whose last token alone carries the model's suffix; else None."""
    model = spec["model"]
    suffix = model.get("end_of_word_suffix")
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    if (model.get("type") != "BPE" or not suffix or suffix.isalpha() or model.get("dropout")
            or r"|[\p{L}]+|" not in pattern
            or any(t["content"].isalpha() for t in spec.get("added_tokens", []))):
        return None
    last = np.zeros(size, bool)
    last[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True
    return last


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, chunks) -> None:
    """Write a whole file: under a name of its own, then renamed."""
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    mine = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(mine) as out:
        for chunk in chunks:
            out.write(chunk)
    store.move(mine, f"{root}/{name}")


def _map(folder: str, name: str, dtype) -> np.ndarray:
    """A file's numbers: memory-mapped on a mounted folder, else read."""
    store, root = _filesystem(folder)
    if isinstance(store, fs.LocalFileSystem):
        path = f"{root}/{name}"
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with store.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def _writer(path: str, end_id: int | None, folder: str):
    def run(batches):
        from pyspark import TaskContext

        coder = memo.held(("words", path), lambda: WordTokenizer(path))
        shard = TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], coder.dtype).tobytes()
        sizes, ids = [], []

        def chunks():
            for batch in small_batches(batches, "text"):
                texts = batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
                packed = coder.encode(texts)
                sizes.append(np.array([len(p) + len(end) for p in packed], np.int64) // coder.dtype.itemsize)
                ids.append(batch.column("doc_id").fill_null(NO_ID).to_numpy())
                yield end.join(packed) + end

        _put(folder, f"tokens-{shard:06d}.bin", chunks())
        lengths = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        _put(folder, f"tokens-{shard:06d}.doc",
             [np.concatenate(ids).astype("<i8").tobytes() if ids else b""])
        local = np.concatenate([[0], np.cumsum(lengths)])
        _put(folder, f"tokens-{shard:06d}.len", [local.astype("<i8").tobytes()])
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(lengths)],
                                          "n_ids": [int(local[-1])], "wide": [coder.wide]})
    return run


def _offset_writer(folder: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                name = f"tokens-{row['shard']:06d}"
                local = _map(folder, f"{name}.len", "<i8")
                _put(folder, f"{name}.idx", [(np.asarray(local) + row["base"]).astype("<i8").tobytes()])
            yield batch
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 2,
                      shards: int | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files; returns the manifest
    (shard, n_docs, n_ids, wide, base: ids before the shard), staged.

    Null texts are empty (the end id alone), a null doc_id comes first, rows
    with one doc_id are ordered by text, an empty table gives empty files.
    Other columns are not read. ``shards`` defaults to the session's shuffle
    partitions; the rows are dealt by ranges of doc_id (from a sample of ids alone).
    """
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    manifest = staged(rows.mapInArrow(_writer(tokenizer_path, end_id, folder),
                                      "shard long, n_docs long, n_ids long, wide boolean"), "token-shards")
    # one row a shard: as many rows as files, whatever the input
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return staged(based.repartition(n, "shard").mapInArrow(_offset_writer(folder), based.schema), "token-bases")


def _reader(folder: str):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                name = f"tokens-{row['shard']:06d}"
                offsets = _map(folder, f"{name}.idx", "<i8")
                docs = _map(folder, f"{name}.doc", "<i8")
                ids = _map(folder, f"{name}.bin", "<u4" if row["wide"] else "<u2")
                base = int(offsets[0])
                for at in range(0, len(docs), 4096):
                    own = np.asarray(docs[at:at + 4096])
                    start = np.asarray(offsets[at:at + len(own) + 1])
                    crc = [zlib.crc32(ids[a - base:b - base].astype("<u4")) for a, b in zip(start, start[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(start[:-1], pa.int64()),
                         pa.array(np.diff(start), pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers) of
    every document, from the files alone."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "shard").mapInArrow(
        _reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(folder: str, shard: int, row: int, wide: bool = False) -> np.ndarray:
    """The ids of one document of one shard, mapped."""
    name = f"tokens-{shard:06d}"
    offsets = _map(folder, f"{name}.idx", "<i8")
    ids = _map(folder, f"{name}.bin", "<u4" if wide else "<u2")
    return ids[offsets[row] - offsets[0]:offsets[row + 1] - offsets[0]]
