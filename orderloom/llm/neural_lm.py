"""Log-bilinear language model trained by noise-contrastive estimation.

The OWN most frequent words, the end of a text first among them, are predicted
one by one; all others share ENDINGS classes by their last three bytes and have,
within their class, their add-one share of the counted words. The embedding of
what comes next is a linear map of the embeddings of the two words before.
Training tells what occurs from what is drawn at its overall rate; afterwards a
product of two matrices gives the normaliser of every pair of words before, as
the exponent is a sum of what either says. So every text has a probability, words
never seen included, and a token costs a look into three tables.

All training texts are counted, and all their tokens train: a start is learned on
the driver from a bounded sample of tokens, then every Spark partition goes over
its own tokens once from there, and what the partitions found is averaged by how
many tokens they have. Frequent words are scored where the text is; the counts of
rare ones are joined to the texts that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.batches import SPACED, Texts, Words, map_batches, map_texts, pieces, sums
from orderloom.llm.spread import most_frequent
from orderloom.scratch import new_scratch, written

#: Classes of one word (the end of a text among them), and classes by ending.
OWN, ENDINGS = 1024, 1024
CLASSES = OWN + ENDINGS
#: Class that stands before a text's first word, as context only.
_START = CLASSES
#: Words that are broadcast with their counts, the most frequent ones of at most so many bytes.
HEAD_WORDS, HEAD_BYTES = 1 << 18, 64
#: The end of a text as a word; no word is empty.
END = b""

#: Embeddings, tokens of a step, words drawn as noise for a step, rate of learning.
WIDTH, BATCH, NOISE, RATE = 32, 4096, 128, 0.1
#: Tokens at most, on average, that the start is learned from, and its steps.
START_TOKENS, START_STEPS = 2_000_000, 1000
#: Numbers of the model that are averaged together.
_BLOCK = 4096


def ending(word: bytes) -> int:
    return int(_endings(np.frombuffer(word, np.uint8), np.zeros(1, np.int64), np.array([len(word)]))[0])


def _endings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class by ending of the words ``data[starts:ends]``."""
    mixed = np.zeros(len(ends), np.uint64)
    for k in range(1, 4):
        inside = ends - k >= starts
        byte = data[np.where(inside, ends - k, 0)] if len(data) else np.zeros(len(ends), np.uint8)
        mixed = (mixed << np.uint64(8)) | np.where(inside, byte, 0).astype(np.uint64)
    mixed = (mixed + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(ENDINGS)).astype(np.int64)


def _endings_of_distinct(words: Words) -> np.ndarray:
    """Class by ending per different word, taken where it occurs last."""
    some = np.zeros(len(words.distinct_array), np.int64)
    some[words.codes] = np.arange(len(words.codes))
    return _endings(words.data, words.starts[some], words.ends[some])


def count_words(documents: DataFrame) -> DataFrame:
    """word, ending and n over all ``documents``, each with one end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = Texts.of(piece.column("text")).lower().words(SPACED)
                distinct = [*words.distinct, END]
                n = np.append(np.bincount(words.codes, minlength=len(distinct) - 1), len(piece))
                endings = np.append(_endings_of_distinct(words), ending(END)) if len(words.codes) else np.array([ending(END)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct, pa.binary()), pa.array(endings.astype(np.int32)), pa.array(n.astype(np.int64))],
                    names=["word", "ending", "n"],
                )

    found = map_batches(documents.select("text"), run, "word binary, ending int, n bigint")
    return found.groupBy("word", "ending").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Classes:
    """Classes of words: ``own``, the end first, have one each."""

    own: list[bytes]

    def number(self, words: Words) -> np.ndarray:
        """Per different word its own class, or -1."""
        known = pa.array(self.own, pa.large_binary())
        found = pc.index_in(words.distinct_array.cast(pa.large_binary()), value_set=known)
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def of(self, words: Words) -> np.ndarray:
        """Classes of all words and ends, text after text, each text after two starts."""
        n = len(words.at) - 1
        at = words.at + 3 * np.arange(n + 1)
        out = np.full(at[-1], _START, np.int64)
        out[at[1:] - 1] = 0
        if len(words.starts):
            own = self.number(words)
            classes = np.where(own < 0, OWN + _endings_of_distinct(words), own)[words.codes]
            out[np.arange(len(classes)) + 3 * words.text_of_word() + 2] = classes
        return out


def triples(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its class, the one before and the one before that."""
    place = np.flatnonzero(classes != _START)
    return classes[place], classes[place - 1], classes[place - 2]


class Net:
    """What is trained: embeddings of contexts and of targets, a map for either place before, biases."""

    SHAPES = {
        "context": (CLASSES + 1, WIDTH),
        "near": (WIDTH, WIDTH),
        "far": (WIDTH, WIDTH),
        "target": (CLASSES, WIDTH),
        "bias": (CLASSES,),
    }

    def __init__(self, rate: np.ndarray):
        rng = np.random.default_rng(11)
        self.rate = rate
        self.p = {
            "context": rng.normal(0, 0.1, self.SHAPES["context"]),
            "near": np.eye(WIDTH) + rng.normal(0, 0.01, (WIDTH, WIDTH)),
            "far": 0.5 * np.eye(WIDTH) + rng.normal(0, 0.01, (WIDTH, WIDTH)),
            "target": rng.normal(0, 0.1, self.SHAPES["target"]),
            "bias": np.log(rate),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.squares = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.p.items()}

    def step(self, word: np.ndarray, near: np.ndarray, far: np.ndarray, noise: np.ndarray) -> None:
        """One step of noise-contrastive estimation, with the same noise for all tokens of the step."""
        p, log_rate = self.p, np.log(NOISE * self.rate).astype(np.float32)
        a, b, t = p["context"][near], p["context"][far], p["target"][word]
        predicted = a @ p["near"] + b @ p["far"]
        true = np.einsum("ij,ij->i", predicted, t) + p["bias"][word] - log_rate[word]
        false = predicted @ p["target"][noise].T
        false += (p["bias"] - log_rate)[noise]
        d_true = (_sigmoid(true) - 1) / len(word)
        d_false = _sigmoid(false)
        d_false /= len(word)
        d_predicted = d_true[:, None] * t + d_false @ p["target"][noise]
        rows = np.concatenate([d_true[:, None] * predicted, d_false.T @ predicted])
        bias = np.bincount(word, d_true, CLASSES) + np.bincount(noise, d_false.sum(axis=0), CLASSES)
        contexts = np.concatenate([d_predicted @ p["near"].T, d_predicted @ p["far"].T])
        self._move("target", *_summed(np.concatenate([word, noise]), rows))
        self._move("context", *_summed(np.concatenate([near, far]), contexts))
        for name, g in (("bias", bias), ("near", a.T @ d_predicted), ("far", b.T @ d_predicted)):
            self._move(name, slice(None), g)

    def _move(self, name: str, rows, g: np.ndarray) -> None:
        self.squares[name][rows] += g * g
        self.p[name][rows] -= RATE * g / np.sqrt(self.squares[name][rows])

    def learn(self, word: np.ndarray, near: np.ndarray, far: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the tokens, in an order of its own."""
        order = rng.permutation(len(word))
        noise = np.searchsorted(np.cumsum(self.rate), rng.random((-(-len(word) // BATCH), NOISE)) * (1 - 1e-12))
        for i, drawn in zip(range(0, len(word), BATCH), noise, strict=True):
            some = order[i : i + BATCH]
            self.step(word[some], near[some], far[some], np.minimum(drawn, CLASSES - 1))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[name].ravel() for name in self.SHAPES])

    def set_flat(self, flat: np.ndarray) -> None:
        at = 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.p[name] = flat[at : at + size].reshape(shape).astype(np.float32)
            at += size

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 tables by (word before, word), (word before that, word) and (both): what is to be
        added, added and subtracted. One product over all pairs of contexts normalises."""
        p = {k: v.astype(np.float64) for k, v in self.p.items()}
        near = p["context"] @ p["near"] @ p["target"].T + p["bias"]
        far = p["context"] @ p["far"] @ p["target"].T
        near -= near.max(axis=1, keepdims=True)
        far -= far.max(axis=1, keepdims=True)
        total = np.log10(np.exp(near) @ np.exp(far).T)
        return (near / np.log(10)).astype(np.float32), (far / np.log(10)).astype(np.float32), total.astype(np.float32)


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, and the sum of the values of each."""
    # Classes fit 16 bits, which are sorted by radix.
    order = np.argsort(rows.astype(np.int16), kind="stable")
    begin = np.flatnonzero(np.diff(rows[order], prepend=-1))
    return rows[order[begin]], np.add.reduceat(values[order], begin, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.clip(x, -30, 30)
    np.negative(out, out=out)
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


def _classes_of(batches: Iterator[pa.RecordBatch], classes: Classes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for piece in pieces(batch):
            yield triples(classes.of(Texts.of(piece.column("text")).lower().words(SPACED)))


def train(documents: DataFrame, classes: Classes, rate: np.ndarray, n_tokens: int) -> Net:
    """A net trained on all tokens of ``documents``."""
    net = Net(rate)
    every = max(1, -(-n_tokens // START_TOKENS))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _classes_of(batches, classes):
            mixed = np.arange(len(found[0]), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            chosen = (mixed >> np.uint64(40)) % np.uint64(every) == 0
            yield pa.RecordBatch.from_arrays([pa.array(x[chosen].astype(np.int32)) for x in found], names=["word", "near", "far"])

    # Bounded: one token in ``every``.
    some = map_batches(documents.select("text"), sample, "word int, near int, far int").toArrow()
    tokens = np.stack([some.column(c).to_numpy().astype(np.int64) for c in ("word", "near", "far")])
    tokens = tokens[:, np.lexsort(tokens)]
    rng = np.random.default_rng(17)
    for _ in range(-(-START_STEPS * BATCH // max(1, tokens.shape[1])) if tokens.shape[1] else 0):
        net.learn(*tokens[:, rng.permutation(tokens.shape[1])[: START_STEPS * BATCH]], rng)

    shared = documents.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Net(rate)
        start = shared.value.flat()
        mine.set_flat(start.copy())
        mine.squares = {k: v.copy() for k, v in shared.value.squares.items()}
        rng, n = np.random.default_rng(19), 0
        for found in _classes_of(batches, classes):
            mine.learn(*found, rng)
            n += len(found[0])
        change = (mine.flat() - start) * np.float32(n)
        blocks = [change[i : i + _BLOCK].tobytes() for i in range(0, len(change), _BLOCK)] if n else []
        places = pa.array(range(len(blocks)), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array([n] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "n", "change"])

    def mean(table: pa.Table) -> pa.Table:
        change = sum(np.frombuffer(b, np.float32).astype(np.float64) for b in table.column("change").to_pylist())
        n = pc.sum(table.column("n")).as_py()
        return pa.table({"block": table.column("block")[:1], "change": pa.array([(change / n).astype(np.float32).tobytes()], pa.binary())})

    found = map_batches(documents.select("text"), run, "block int, n bigint, change binary")
    # Bounded: the numbers of one model.
    found = found.groupBy("block").applyInArrow(mean, "block int, change binary").toArrow()
    shared.destroy()
    if len(found):
        flat = net.flat()
        for block, change in zip(found.column("block").to_pylist(), found.column("change").to_pylist(), strict=True):
            flat[block * _BLOCK : (block + 1) * _BLOCK] += np.frombuffer(change, np.float32)
        net.set_flat(flat)
    return net


@dataclass(frozen=True)
class LanguageModel:
    """``near``, ``far``, ``total``: see ``Net.tables``; ``shares``: log10 of what a class divides its counts by."""

    classes: Classes
    near: np.ndarray
    far: np.ndarray
    total: np.ndarray
    shares: np.ndarray
    head: dict[bytes, int]
    ends: int
    n_tokens: int
    n_words: int

    def log10(self, classes: np.ndarray) -> np.ndarray:
        """Per token log10 P(its class | the two before)."""
        word, near, far = triples(classes)
        return self.near[near, word].astype(np.float64) + self.far[far, word] - self.total[near, far]


def fit(documents: DataFrame, may_learn: Column, folder: str) -> tuple[LanguageModel, DataFrame]:
    """The model, and the counts of all words of the documents for which ``may_learn`` holds."""
    spark = documents.sparkSession
    known = documents.where(may_learn)
    counts = written(spark, count_words(known), f"{folder}/words")
    n_tokens, n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # Bounded: HEAD_WORDS rows of at most HEAD_BYTES and a count.
    head = _most_frequent_words(counts, HEAD_WORDS)
    ends = counts.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    size = F.octet_length("word")
    top = counts.where((size > 0) & (size <= HEAD_BYTES)).orderBy(F.desc("n"), "word").limit(OWN - 1)
    own_counts = {END: ends} | {bytes(r["word"]): r["n"] for r in top.collect()}
    own, head = list(own_counts), head | own_counts
    classes = Classes(own)
    shared = counts.where(~F.col("word").isin([bytearray(w) for w in own]))
    of_class = shared.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    shares, rate = np.zeros(CLASSES), np.full(CLASSES, 0.5)
    rate[: len(own)] += list(own_counts.values())
    for r in of_class:
        shares[OWN + r["ending"]] = np.log10(r["n"] + r["words"] + 1)
        rate[OWN + r["ending"]] += r["n"]
    net = train(known, classes, rate / rate.sum(), n_tokens)
    return LanguageModel(classes, *net.tables(), shares, head, ends, n_tokens, n_words), counts


def _most_frequent_words(counts: DataFrame, limit: int) -> dict[bytes, int]:
    found = most_frequent(counts.where(F.octet_length("word") <= HEAD_BYTES), limit).select("word", "n").toArrow()
    return dict(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True))


def score(documents: DataFrame, may_learn: Column) -> DataFrame:
    """Every document with its base score and the model's log10 probability of its text.

    Returned: doc_id, n_tokens (words and one end), n_known (tokens that the
    training texts hold), train_tokens, base_score, score. Null counts as empty:
    its only token is the end. Repeated rows are scored alike; an empty table
    has an empty result; with nothing to learn from, every word is unknown.
    """
    spark = documents.sparkSession
    folder = new_scratch(spark, "language-model")
    model, counts = fit(documents, may_learn, folder)
    shared = spark.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        m: LanguageModel = shared.value
        words = Texts.of(batch.column("text")).lower().words(SPACED)
        distinct, n = words.distinct, len(batch)
        c = np.fromiter((m.head.get(w, -1) for w in distinct), np.int64, len(distinct))
        log_c = np.log10(np.maximum(c, 0) + 1.0)
        of_class = np.where(m.classes.number(words) >= 0, 0.0, log_c)
        classes = m.classes.of(words)
        value = m.log10(classes) - m.shares[classes[classes != _START]]
        logs = np.stack([log_c, of_class, (c > 0).astype(np.float64)], axis=1)
        per_text = sums(logs[words.codes], words.at) if len(distinct) else np.zeros((n, 3))
        tokens = words.counts + 1
        base = per_text[:, 0] + np.log10(m.ends + 1.0) - tokens * np.log10(m.n_tokens + m.n_words + 1.0)
        mine = sums(value, words.at + np.arange(n + 1)) + per_text[:, 1]
        # Words beyond the head, each once per text.
        rare = np.flatnonzero((c < 0)[words.codes]) if len(distinct) else np.zeros(0, np.int64)
        pair, many = np.unique(words.text_of_word()[rare] * max(1, len(distinct)) + words.codes[rare], return_counts=True)
        owner, code = pair // max(1, len(distinct)), pair % max(1, len(distinct))
        at = np.searchsorted(owner, np.arange(n + 1))
        found = [words.distinct_array.cast(pa.binary()).take(pa.array(code)), pa.array(many.astype(np.int64))]
        rows = pa.StructArray.from_arrays(found, ["word", "times"])
        return [
            pa.array(tokens),
            pa.array((per_text[:, 2] + (m.ends > 0)).astype(np.int64)),
            pa.array(base),
            pa.array(mine),
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows),
        ]

    schema = "n_tokens bigint, n_known bigint, base double, mine double, rare array<struct<word: binary, times: bigint>>"
    found = map_texts(documents, work, schema).withColumn("row", F.monotonically_increasing_id())
    # Written, so that the row numbers stay what they are.
    found = written(spark, found, f"{folder}/scored")
    rare = found.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.times")
    # Words that are in no training text add nothing.
    added = (
        rare.join(counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs"), F.sum("times").alias("more_known"))
    )
    return found.drop("rare").join(added, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("mine") + F.coalesce("logs", F.lit(0.0))).alias("score"),
    )
