"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces; each language has one probability
per piece. A word (lower-cased letters that follow each other, 63 at most, so that
a longer run is several words, in training and scoring alike; behind a word mark)
has as its likelihood the sum over *all* its segmentations into pieces of the product of
their probabilities, computed by the forward algorithm over character
positions. Characters that are no piece are spelled by their byte pieces. A
text's likelihood is the product over its words; with the languages' shares of
training letters as prior, the posterior gives prediction and score.

Training is expectation maximisation on (language, word) counts over all
training rows: the counts are grouped by Spark with copies combined in each
task; each round's expected piece counts come from forward and backward sums
over every distinct word, and only (piece, language) totals, whose number is
fixed by the vocabulary, reach the driver.

Work per distinct word is vectorised over words of one length: one recurrence for
all, in which sums that get small are rescaled and the scale's log is kept. A
worker remembers the likelihoods of words it has met (bounded).
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import memo
from .common import mix64, small_batches, staged

MARK = "▁"
UNKNOWN = "und"
LONG = 64
REMEMBERED = 200_000
LETTERS = re.compile(rf"[^\W\d_]{{1,{LONG - 1}}}")
#: Positions between looks at the size of the sums, and what is small. The
#: pieces of so many positions (four bytes each) can't take them to zero.
EVERY, SMALL = 4, 1e-100


class Vocabulary:
    """Pieces of a SentencePiece model that may spell a lower-cased word: hash
    of each piece, and ids of the byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces, ids = [], []
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        for i in range(self.size):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                pieces.append(model.id_to_piece(i))
                ids.append(i)
        self.most = max(map(len, pieces))
        self.ids = dict(zip(pieces, ids))
        keys = np.array([_key(p) for p in pieces], np.uint64)
        #: by top bits of a hash: whether any piece has them
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[keys >> np.uint64(44)] = True
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(ids)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a hash")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, piece ids) of the substring hashes that are pieces."""
        rows = np.flatnonzero(self.maybe[keys >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, keys[rows]), len(self.keys) - 1)
        hit = self.keys[at] == keys[rows]
        return rows[hit], self.key_ids[at[hit]]


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _key(text: str) -> int:
    h = 0
    for c in text:
        h = ((h * int(_STEP)) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return int(mix64(np.array([h], np.uint64))[0])


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points (words x length) of marked words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


class Lattice:
    """Arcs of equally long words: by start and end position, the words in which
    that substring is a piece, and the pieces; lone characters that are no
    piece have an arc spelled in byte pieces."""

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        length = len(words[0])
        codes = _codes(words, length)
        self.n, self.length, self.most = len(words), length, vocabulary.most
        self.arcs: list[list[tuple]] = [[] for _ in range(length)]   # start: (end, rows, piece ids)
        self.spelled: list[list[tuple]] = [[] for _ in range(length)]  # start: (row, byte piece ids)
        for start in range(length):
            h = np.zeros(self.n, np.uint64)
            for end in range(start + 1, min(length, start + vocabulary.most) + 1):
                h = h * _STEP + codes[:, end - 1] + np.uint64(1)
                rows, ids = vocabulary.find(mix64(h))
                if len(rows):
                    self.arcs[start].append((end, rows, ids))
                if end == start + 1 and len(rows) < self.n:
                    for row in np.setdiff1d(np.arange(self.n), rows):
                        spelling = vocabulary.byte[list(words[row][start].encode("utf-8", "replace"))]
                        self.spelled[start].append((int(row), spelling))

    def _rescale(self, sums: np.ndarray, logs: np.ndarray | None, at: int, later: slice) -> np.ndarray | None:
        """If row ``at`` holds a small sum, divide the rows that later steps
        read by their greatest value for each word and language. ``logs`` (None:
        all 0) are the logs of what rows were divided by, and so what ``later``
        rows, read or yet to be made, are divided by."""
        if at % EVERY or sums[at].min() >= SMALL:
            return logs
        read = slice(at, at + self.most + 1)
        top = sums[read].max(axis=0)
        top[top == 0] = 1
        sums[read] /= top
        if logs is None:
            logs = np.zeros_like(sums)
        logs[later] += np.log(top)
        return logs

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """alpha (length + 1, words, languages): summed weight of all
        segmentations of each prefix, with (piece, language) weights p; and the
        logs of what its rows were divided by."""
        alpha, logs = np.zeros((self.length + 1, self.n, p.shape[1])), None
        alpha[0] = 1
        for start in range(self.length):
            logs = self._rescale(alpha, logs, start, slice(start, None))
            for end, rows, ids in self.arcs[start]:
                alpha[end, rows] += alpha[start, rows] * p[ids]
            for row, spelling in self.spelled[start]:
                alpha[start + 1, row] += alpha[start, row] * p[spelling].prod(axis=0)
        return alpha, logs

    def backward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """The same of each suffix."""
        beta, logs = np.zeros((self.length + 1, self.n, p.shape[1])), None
        beta[self.length] = 1
        for start in reversed(range(self.length)):
            for end, rows, ids in self.arcs[start]:
                beta[start, rows] += beta[end, rows] * p[ids]
            for row, spelling in self.spelled[start]:
                beta[start, row] += beta[start + 1, row] * p[spelling].prod(axis=0)
            logs = self._rescale(beta, logs, start, slice(0, start + self.most + 1))
        return beta, logs

    def logs(self, p: np.ndarray) -> np.ndarray:
        """Log likelihoods (words, languages)."""
        alpha, logs = self.forward(p)
        whole = np.log(np.maximum(alpha[self.length], 5e-324))
        return whole if logs is None else whole + logs[self.length]

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``counts`` (words, languages)."""
        (alpha, a), (beta, b) = self.forward(p), self.backward(p)
        end_sum = np.maximum(alpha[self.length], 5e-324)
        if a is None and b is None:
            weight = counts / end_sum

            def share(start, end, rows, piece):
                return alpha[start, rows] * beta[end, rows] * piece * weight[rows]
        else:
            none = np.zeros_like(alpha)
            a, b = none if a is None else a, none if b is None else b
            whole = np.log(end_sum) + a[self.length]

            def share(start, end, rows, piece):
                with np.errstate(divide="ignore"):
                    logs = (np.log(alpha[start, rows]) + np.log(beta[end, rows]) + np.log(piece)
                            + a[start, rows] + b[end, rows] - whole[rows])
                return np.exp(logs) * counts[rows]

        ids, uses = [np.zeros(0, np.int64)], [np.zeros((0, p.shape[1]))]
        for start in range(self.length):
            for end, rows, piece in self.arcs[start]:
                ids.append(piece)
                uses.append(share(start, end, rows, p[piece]))
            for row, spelling in self.spelled[start]:
                use = share(start, start + 1, row, p[spelling].prod(axis=0))
                ids.append(spelling)
                uses.append(np.repeat(use[None], len(spelling), axis=0))
        at, use = np.concatenate(ids), np.concatenate(uses)
        return np.stack([np.bincount(at, use[:, k], minlength=len(p)) for k in range(p.shape[1])], axis=1)


def word_logs(vocabulary: Vocabulary, p: np.ndarray, words: list[str]) -> np.ndarray:
    """Log likelihoods (words, languages) of marked words."""
    out = np.empty((len(words), p.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for rows in by_length.values():
        for at in range(0, len(rows), 8192):
            part = rows[at:at + 8192]
            out[part] = Lattice(vocabulary, [words[i] for i in part]).logs(p)
    return out


def _words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _counter(flush: int = 300_000):
    def run(batches):
        held: dict[str, Counter] = {}

        def out():
            for lang, words in held.items():
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(words), pa.string()),
                     "word": pa.array(list(words), pa.string()),
                     "n": pa.array(list(words.values()), pa.int64())})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(_words(text))
                if sum(map(len, held.values())) > flush:
                    yield from out()
        yield from out()
    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over ``docs`` with text and lang."""
    return (docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
            .mapInArrow(_counter(), "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray          # log share of each language
    pieces: np.ndarray         # (vocabulary + 1, languages), last row zeros
    vocabulary_path: str
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def _expectation(path: str, languages: list[str], pieces):
    """Words are gathered by length, so that one lattice takes many."""
    def run(batches):
        vocabulary = memo.held(("language pieces", path), lambda: Vocabulary(path))
        p, place = pieces.value, {l: i for i, l in enumerate(languages)}
        total = np.zeros_like(p)
        held: dict[int, dict[str, list]] = {}

        def close(length: int) -> np.ndarray:
            words = held.pop(length)
            counts = np.zeros((len(words), len(languages)))
            for i, uses in enumerate(words.values()):
                for lang, n in uses:
                    counts[i, lang] = n
            return Lattice(vocabulary, list(words)).expected(p, counts)

        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                words = held.setdefault(len(word), {})
                words.setdefault(MARK + word, []).append((place[lang], n))
                if len(words) >= 8192:
                    total += close(len(word))
        for length in list(held):
            total += close(length)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(piece, pa.int64()),
                                          "lang": pa.array(lang, pa.int64()),
                                          "n": pa.array(total[piece, lang])})
    return run


def train(docs: DataFrame, vocabulary_path: str, rounds: int = 2, smoothing: float = 0.02) -> Model | None:
    """Piece probabilities of every language in ``docs`` (text, lang); None
    without a training word. Rows without text or lang teach nothing."""
    spark = docs.sparkSession
    counts = staged(word_counts(docs), "language-words")
    totals = sorted(counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    if not totals:
        return None
    languages = [r["lang"] for r in totals]
    share = np.array([r["n"] for r in totals], float)
    vocabulary = Vocabulary(vocabulary_path)
    p = np.zeros((vocabulary.size + 1, len(languages)))
    p[:-1] = 1 / vocabulary.size
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(p)     # vocabulary x languages: of fixed size
        got = (counts.mapInArrow(_expectation(vocabulary_path, languages, sent),
                                 "piece long, lang long, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        p = np.zeros_like(p)
        p[got["piece"], got["lang"]] = got["n"]
        p[:-1] += smoothing
        p /= p.sum(axis=0)
    return Model(languages, np.log(share / share.sum()), p, vocabulary_path)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = Vocabulary(model.vocabulary_path)
        self.memo = memo.Memo(self._new, REMEMBERED, longest=LONG, together=1 << 18)
        self.rows: np.ndarray

    def _new(self, words: list[str]) -> list[np.ndarray]:
        logs = word_logs(self.vocabulary, self.model.pieces, [MARK + w for w in words])
        return [row.astype(np.float32).tobytes() for row in logs]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Log likelihood of each text in each language, prior included."""
        n = len(self.model.languages)
        logs = self.memo.values([_words(t) for t in texts])
        return np.array([np.frombuffer(b"".join(own), np.float32).reshape(-1, n).sum(axis=0, dtype=float)
                         for own in logs]).reshape(-1, n) + self.model.prior


def _predictor(sent, keep: list[str]):
    def run(batches):
        model = sent.value
        scorer = memo.held(("languages", model.key), lambda: Scorer(model)) if model else None
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            none = [t is None or LETTERS.search(t) is None for t in texts]
            if scorer is None:
                name, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            else:
                logs = scorer(texts)
                best = logs.argmax(axis=1)
                odds = np.exp(logs - logs.max(axis=1, keepdims=True))
                score = np.where(none, 0.0, 1 / odds.sum(axis=1))
                name = [UNKNOWN if z else model.languages[b] for z, b in zip(none, best)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(name, pa.string()), pa.array(score, pa.float64())],
                [*keep, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row with lang_pred and score (0 to 1): the
    posterior of the predicted language. ``und`` with score 0 if the text is
    null or has no letter, or nothing was learned. Ties go to the language that
    comes first by code point. Repeated rows give repeated rows. Kept columns
    named like the new ones give way to them."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    keep = [c for c in keep if c.lower() not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = StructType([*(rows.schema[c] for c in keep), StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return rows.mapInArrow(_predictor(sent, keep), schema)
