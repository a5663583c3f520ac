"""Language-model scoring with a log-bilinear model trained by noise-contrastive
estimation.

*Outputs.* The model predicts one of ``words`` frequent words, the end of the
text, or one of ``tails`` classes of all other words (by a hash of the last two
bytes, so every word, seen or not, has one). A word of a class then has
probability (c + 1) / (n + v + 1) within it: c its training count, n and v the
tokens and distinct words of the class.

*Model.* The vectors of the last two outputs, each scaled by the weights of its
position, add up to a prediction; an output's score is the product of the
prediction with its own vector plus its bias. Biases begin at the unigram log
probabilities. Training is noise-contrastive: observed outputs are told from
noise drawn from the unigrams, in batches of matrix products with AdaGrad. Every
task trains on its share of all training texts: each round on every ``stride``-th
position of a text, the rounds together on all of them. The tasks' parameters
are averaged, weighted by positions, through a shuffle of parameter slices.

*Scoring.* Probabilities are normalised over all outputs: the logarithm of the
normaliser of each pair of context outputs (a table of fixed size) comes from
batched matrix products over Spark tasks, once.

*Counts* cover all training texts. Words are 64-bit hashes of their lower-cased
bytes (two distinct words of a corpus share one with probability of about v^2 /
2^65). The most frequent ``known`` words at most, a fixed bound, go to every
task; counts of rarer words meet the texts that hold them in a shuffle join.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, binary_array, list_array, mix64, pieces, small_batches, staged, text_bytes


@dataclass(frozen=True)
class Settings:
    words: int = 1792
    tails: int = 255
    known: int = 1 << 18
    size: int = 16             # of an output's vector
    noise: int = 64            # noise outputs of a batch
    batch: int = 4096
    rate: float = 0.05
    rounds: int = 2
    stride: int = 2            # rounds that it takes to see every position
    slices: int = 32
    seed: int = 5

    @property
    def outputs(self) -> int:
        return self.words + self.tails + 1


#: Hash that stands for the end of a text, and its output number.
END_HASH = 0
END = 0


def _tail(buf: np.ndarray, words: Words, tails: int) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = buf[words.ends - 1].astype(np.uint64)
    second = np.where(words.ends - words.starts > 1, buf[words.ends - 2], 0).astype(np.uint64)
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += np.uint64(32)
    return (mix64(lower[last] + (lower[second] << np.uint64(8)) + np.uint64(1)) % np.uint64(tails)).astype(np.int32)


def _counter(settings: Settings, flush: int = 400_000):
    def run(batches):
        held: list[tuple] = []
        size = texts = 0

        def out():
            h, at, n = np.concatenate([x[0] for x in held]), None, np.concatenate([x[2] for x in held])
            tail = np.concatenate([x[1] for x in held])
            h, at, back = np.unique(h, return_index=True, return_inverse=True)
            return h, tail[at], np.bincount(back, n).astype(np.int64)

        def batch_of(h, tail, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(tail), pa.array(n)],
                                              ["hash", "tail", "n"])

        for batch in batches:
            texts += batch.num_rows
            for _, part, offsets in pieces(*text_bytes(batch.column("text"))):
                words = Words(part, offsets)
                if not len(words.hash):
                    continue
                h, at, n = np.unique(words.hash, return_index=True, return_counts=True)
                held.append((h, _tail(part, words, settings.tails)[at], n))
                size += len(h)
                if size > flush:
                    merged = out()
                    held, size = [merged], len(merged[0])
                    if size > flush // 2:
                        yield batch_of(*merged)
                        held, size = [], 0
        if held:
            yield batch_of(*out())
        if texts:
            yield batch_of(np.array([END_HASH], np.uint64), np.array([-1], np.int32), np.array([texts]))
    return run


def token_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """(hash, tail, n) of every distinct token of ``docs`` (text), the end of a
    text included."""
    return (docs.select("text").mapInArrow(_counter(settings), "hash long, tail int, n long")
            .groupBy("hash").agg(F.first("tail").alias("tail"), F.sum("n").alias("n")))


@dataclass
class Counts:
    """What of the counts every task holds."""
    tokens: int                # N
    distinct: int              # V
    hashes: np.ndarray         # of the known words, sorted
    counts: np.ndarray
    outputs: np.ndarray        # output number of each, -1 if not one of its own
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    unigram: np.ndarray        # smoothed probabilities of the outputs
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def summarise(counts: DataFrame, settings: Settings) -> Counts:
    """Counts of the tokens of ``counts``; what is collected has fixed bounds."""
    level = F.floor(F.log2("n") * 64).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    least, room = 1 << 30, settings.known
    for r in sorted(rows, reverse=True):
        if r["v"] > room:
            break
        least, room = r["level"], room - r["v"]
    top = counts.filter(level >= least).filter(F.col("hash") != END_HASH).toPandas()
    ends = sum(r["n"] for r in counts.filter(F.col("hash") == END_HASH).collect())
    per_tail = {r["tail"]: (r["n"], r["v"]) for r in counts.groupBy("tail").agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    h = top["hash"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    h, n, tail = h[order], top["n"].to_numpy(np.int64)[order], top["tail"].to_numpy(np.int64)[order]
    own = np.lexsort((h, -n))[:settings.words]
    number = np.full(len(h), -1, np.int32)
    number[own] = np.arange(1, len(own) + 1)
    tail_n = np.array([per_tail.get(t, (0, 0))[0] for t in range(settings.tails)], np.int64)
    tail_v = np.array([per_tail.get(t, (0, 0))[1] for t in range(settings.tails)], np.int64)
    np.subtract.at(tail_n, tail[own], n[own])
    np.subtract.at(tail_v, tail[own], 1)
    seen = np.zeros(settings.outputs)
    seen[END] = ends
    seen[1:len(own) + 1] = n[own]
    seen[settings.words + 1:] = tail_n
    unigram = (seen + 0.5) / (seen.sum() + 0.5 * settings.outputs)
    return Counts(sum(r["n"] for r in rows), sum(r["v"] for r in rows), h, n, number, tail_n, tail_v, unigram)


def _encoder(sent, ends: int, settings: Settings):
    """Output numbers of each text and the parts of its scores that the known
    counts decide; hashes of its other words."""
    def run(batches):
        c = sent.value
        every = np.log10(c.tokens + c.distinct + 1)
        in_tail = np.log10(c.tail_tokens + c.tail_words + 1)
        for batch in small_batches(batches, "text"):
            n = batch.num_rows
            ids: list[list] = [[] for _ in range(n)]
            rare: list[list] = [[] for _ in range(n)]
            tokens, known = np.ones(n, np.int64), np.full(n, int(ends > 0), np.int64)
            base, inside = np.full(n, np.log10(ends + 1) - every), np.zeros(n)
            for first, part, offsets in pieces(*text_bytes(batch.column("text"))):
                words = Words(part, offsets)
                if not len(words.hash):
                    continue
                tail = _tail(part, words, settings.tails)
                at = np.minimum(np.searchsorted(c.hashes, words.hash), max(len(c.hashes) - 1, 0))
                found = c.hashes[at] == words.hash if len(c.hashes) else np.zeros(len(words.hash), bool)
                number = np.where(found, c.outputs[at], -1) if len(c.hashes) else np.full(len(words.hash), -1)
                up = np.where(found, np.log10((c.counts[at] if len(c.hashes) else 0) + 1.0), 0.0)
                doc = words.doc + first
                tokens += np.bincount(doc, minlength=n)
                known += np.bincount(doc[found], minlength=n)
                base += np.bincount(doc[found], up[found] - every, minlength=n)
                base -= every * np.bincount(doc[~found], minlength=n)
                lone = number >= 0
                inside += np.bincount(doc[~lone], (up - in_tail[tail])[~lone], minlength=n)
                number = np.where(lone, number, settings.words + 1 + tail).astype(np.uint16)
                for k in range(first, first + len(offsets) - 1):
                    a, b = np.searchsorted(doc, (k, k + 1))
                    ids[k].append(number[a:b])
                    rare[k].append(words.hash[a:b][~found[a:b]])
            end = np.full(1, END, np.uint16)
            flat = [np.concatenate([*x, end]) for x in ids]
            seldom = [np.unique(np.concatenate(x) if x else np.zeros(0, np.uint64), return_counts=True) for x in rare]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("row", "doc_id", "held_out")), pa.array(tokens), pa.array(known),
                 pa.array(base), pa.array(inside),
                 binary_array(np.concatenate(flat), np.array([x.nbytes for x in flat])),
                 list_array(np.concatenate([h for h, _ in seldom]).view(np.int64), [len(h) for h, _ in seldom], pa.int64()),
                 list_array(np.concatenate([k for _, k in seldom]), [len(k) for _, k in seldom], pa.int64())],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inside", "ids", "rare", "times"])
    return run


@dataclass
class Model:
    vectors: np.ndarray        # of outputs as context
    targets: np.ndarray        # of outputs as predictions
    places: np.ndarray         # (2, size) weights of the last and the one before
    bias: np.ndarray

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.vectors, self.targets, self.places, self.bias)])

    @classmethod
    def of(cls, flat: np.ndarray, settings: Settings) -> "Model":
        m, d = settings.outputs, settings.size
        a, b, c, e = np.split(flat, np.cumsum([m * d, m * d, 2 * d]))
        return cls(a.reshape(m, d), b.reshape(m, d), c.reshape(2, d), e)

    @classmethod
    def start(cls, unigram: np.ndarray, settings: Settings) -> "Model":
        rng = np.random.default_rng(settings.seed)
        m, d = settings.outputs, settings.size
        return cls(rng.normal(0, 0.1, (m, d)).astype(np.float32), rng.normal(0, 0.1, (m, d)).astype(np.float32),
                   np.ones((2, d), np.float32), np.log(unigram).astype(np.float32))


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the ``rows`` of equal ``at`` (below ``n``), column by column."""
    return np.stack([np.bincount(at, x, minlength=n) for x in rows.T], axis=1)


class Trainer:
    """Noise-contrastive training of one task's copy."""

    def __init__(self, model: Model, unigram: np.ndarray, settings: Settings, seed: int):
        self.model, self.s = model, settings
        self.steps = [np.full_like(x, 1e-2) for x in (model.vectors, model.targets, model.places, model.bias)]
        self.rng = np.random.default_rng([settings.seed, seed])
        self.summed = np.cumsum(unigram)
        self.log_noise = np.log(settings.noise * unigram).astype(np.float32)
        self.seen = 0

    def _noise(self) -> np.ndarray:
        return np.minimum(np.searchsorted(self.summed, self.rng.random(self.s.noise) * self.summed[-1]),
                          len(self.summed) - 1)

    def batch(self, last: np.ndarray, before: np.ndarray, word: np.ndarray) -> None:
        m, rate = self.model, self.s.rate
        va, vb = m.vectors[last], m.vectors[before]
        guess = va * m.places[0] + vb * m.places[1]
        noise = self._noise()
        tw, tn = m.targets[word], m.targets[noise]
        data = (guess * tw).sum(axis=1) + m.bias[word] - self.log_noise[word]
        up = 1 / (1 + np.exp(np.clip(data, -30, 30)))                # 1 - sigmoid
        other = guess @ tn.T
        other += m.bias[noise] - self.log_noise[noise]
        np.clip(other, -30, 30, out=other)
        down = np.negative(other, out=other)                         # the sigmoid, in place
        np.exp(down, out=down)
        down += 1
        np.reciprocal(down, out=down)
        g_guess = up[:, None] * tw - down @ tn
        g_target = _summed(np.concatenate([word, noise]),
                           np.concatenate([up[:, None] * guess, -(down.T @ guess)]), len(m.bias))
        g_bias = np.bincount(word, up, minlength=len(m.bias)) - np.bincount(
            noise, down.sum(axis=0), minlength=len(m.bias))
        g_vector = _summed(np.concatenate([last, before]),
                           np.concatenate([g_guess * m.places[0], g_guess * m.places[1]]), len(m.bias))
        g_place = np.stack([(g_guess * va).sum(axis=0), (g_guess * vb).sum(axis=0)])
        for value, step, g in zip((m.vectors, m.targets, m.places, m.bias), self.steps,
                                  (g_vector, g_target, g_place, g_bias)):
            g = g.astype(np.float32) / np.float32(len(word) ** 0.5)
            step += g * g
            value += rate * g / np.sqrt(step)
        self.seen += len(word)


def _contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(output, last, before) at each position of texts that each end with END;
    the contexts of a beginning are ends."""
    flat = np.concatenate([np.full(2, END, np.uint16), *texts])
    word, last, before = flat[2:], flat[1:-1].copy(), flat[:-2].copy()
    starts = np.cumsum([0, *[len(t) for t in texts]])[:-1]
    second = starts[np.array([len(t) > 1 for t in texts], bool)] + 1
    before[starts] = END
    before[second] = END
    return word, last, before


def _turn(texts: list[np.ndarray], turn: int, stride: int) -> np.ndarray:
    """Positions, over all ``texts``, that round ``turn`` trains on: by their
    place in their own text, so that ``stride`` rounds see each one however the
    texts are dealt out."""
    sizes = [len(t) for t in texts]
    starts = np.cumsum([0, *sizes])
    place = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
    return np.flatnonzero(place % stride == turn % stride)


def _trainer(sent, settings: Settings, turn: int):
    def run(batches):
        from pyspark import TaskContext

        flat, unigram = sent.value
        task = TaskContext.get().partitionId()
        trainer = Trainer(Model.of(flat.copy(), settings), unigram, settings, task * 1000 + turn)
        held, size = [], 0

        def close():
            word, last, before = _contexts(held)
            pick = trainer.rng.permutation(_turn(held, turn, settings.stride))
            for at in range(0, len(pick), settings.batch):
                p = pick[at:at + settings.batch]
                trainer.batch(last[p].astype(np.int64), before[p].astype(np.int64), word[p].astype(np.int64))

        for batch in batches:
            for raw in batch.column("ids"):
                held.append(np.frombuffer(raw.as_buffer(), np.uint16))
                size += len(held[-1])
                if size > settings.stride * settings.batch * 16:
                    close()
                    held, size = [], 0
        if held:
            close()
        if trainer.seen:
            for k, part in enumerate(np.array_split(trainer.model.flat(), settings.slices)):
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array([k], pa.int32()), "seen": pa.array([trainer.seen], pa.int64()),
                    "part": pa.array([part.astype(np.float32).tobytes()], pa.binary())})
    return run


def _averager(batches):
    sums: dict[int, list] = {}
    for batch in batches:
        for k, seen, raw in zip(*(batch.column(c).to_pylist() for c in ("slice", "seen", "part"))):
            part = np.frombuffer(raw, np.float32) * float(seen)
            if k in sums:
                sums[k][0] += seen
                sums[k][1] += part
            else:
                sums[k] = [seen, part.astype(float)]
    for k, (seen, part) in sums.items():
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array([k], pa.int32()), "seen": pa.array([seen], pa.int64()),
            "part": pa.array([(part / seen).astype(np.float32).tobytes()], pa.binary())})


def train(encoded: DataFrame, counts: Counts, settings: Settings) -> Model:
    """A model from the texts of ``encoded`` (ids) by ``rounds`` of training in
    all tasks (``stride`` at least, to see every position) and averaging; the
    unigram start if there are none."""
    spark = encoded.sparkSession
    flat = Model.start(counts.unigram, settings).flat()
    kind = "slice int, seen long, part binary"
    for turn in range(max(settings.rounds, settings.stride)):
        sent = spark.sparkContext.broadcast((flat, counts.unigram))
        got = (encoded.select("ids").mapInArrow(_trainer(sent, settings, turn), kind)
               .repartition(settings.slices, "slice").mapInArrow(_averager, kind).collect())
        if got:
            flat = np.concatenate([np.frombuffer(r["part"], np.float32)
                                   for r in sorted(got, key=lambda r: r["slice"])])
    return Model.of(flat, settings)


def _normaliser(sent, settings: Settings):
    def run(batches):
        m = Model.of(sent.value, settings)
        second = m.vectors * m.places[1]
        for batch in batches:
            for last in batch.column("id").to_pylist():
                guess = m.vectors[last] * m.places[0] + second
                score = guess @ m.targets.T + m.bias
                most = score.max(axis=1)
                logs = most + np.log(np.exp(score - most[:, None]).sum(axis=1))
                yield pa.RecordBatch.from_pydict({
                    "last": pa.array([last], pa.int64()),
                    "logs": pa.array([logs.astype(np.float32).tobytes()], pa.binary())})
    return run


def normalisers(spark, model: Model, settings: Settings) -> np.ndarray:
    """Log normaliser of each context (last, before): outputs x outputs."""
    sent = spark.sparkContext.broadcast(model.flat())
    tasks = min(64, settings.outputs)
    rows = (spark.range(0, settings.outputs, 1, tasks)
            .mapInArrow(_normaliser(sent, settings), "last long, logs binary").collect())
    return np.stack([np.frombuffer(r["logs"], np.float32) for r in sorted(rows, key=lambda r: r["last"])])


def log_probabilities(model: Model, logs: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each output of texts that end with END."""
    word, last, before = _contexts(texts)
    out = np.empty(len(word), np.float32)
    for at in range(0, len(word), 1 << 17):
        w, a, b = (x[at:at + (1 << 17)].astype(np.int64) for x in (word, last, before))
        guess = model.vectors[a] * model.places[0] + model.vectors[b] * model.places[1]
        out[at:at + len(w)] = np.einsum("ij,ij->i", guess, model.targets[w]) + model.bias[w] - logs[a, b]
    return out


def _scorer(sent, settings: Settings):
    def run(batches):
        flat, logs = sent.value
        model = Model.of(flat, settings)
        for batch in batches:
            if not batch.num_rows:
                continue
            score, held, first, size = np.zeros(batch.num_rows), [], 0, 0
            for k, raw in enumerate(batch.column("ids")):
                held.append(np.frombuffer(raw.as_buffer(), np.uint16))
                size += len(held[-1])
                if size > 1 << 18 or k == batch.num_rows - 1:
                    p = log_probabilities(model, logs, held).astype(float)
                    score[first:k + 1] = np.add.reduceat(p, np.cumsum([0, *map(len, held)])[:-1]) / np.log(10)
                    held, first, size = [], k + 1, 0
            score += batch.column("inside").to_numpy()
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(score)], [*names, "score"])
    return run


def score_texts(docs: DataFrame, held_out, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score. The model learns from
    the rows where the column ``held_out`` is false.

    A null text is empty: the end is its one token. Without training rows
    counts are 0, base scores 0 and the model is uniform. Repeated rows are rows
    of their own, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), F.col("text"), held_out.alias("held_out"))
    counts = staged(token_counts(rows.filter("NOT held_out"), settings), "lm-counts")
    known = summarise(counts, settings)
    ends = next((r["n"] for r in counts.filter(F.col("hash") == END_HASH).collect()), 0)
    sent = spark.sparkContext.broadcast(known)
    encoded = staged(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _encoder(sent, ends, settings),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "inside double, ids binary, rare array<long>, times array<long>"), "lm-encoded")
    model = train(encoded.filter("NOT held_out"), known, settings)
    table = spark.sparkContext.broadcast((model.flat(), normalisers(spark, model, settings)))
    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "inside", "ids"
                            ).mapInArrow(_scorer(table, settings),
                                         "row long, doc_id long, held_out boolean, n_tokens long, "
                                         "n_known long, base_score double, score double")
    # rarer words: their counts come to them; a word that was not seen adds log10(1)
    rare = (encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
            .select("row", F.col("r.rare").alias("hash"), F.col("r.times").alias("times"))
            .join(counts.select("hash", "n"), "hash")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("up"),
                                F.sum("times").alias("more")))
    up, more = F.coalesce("up", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + up).alias("base_score"),
        (F.col("score") + up).alias("score"))
