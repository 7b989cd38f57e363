"""Language of whole texts: averaged hashed subword embeddings and a linear softmax.

Subwords are runs of 2 to 4 bytes of a word with its ends marked, hashed into a
fixed number of rows. A text is the mean of its subwords' embeddings. Training is
stochastic gradient descent in numpy on a bounded sample; a part of the sample is
kept apart to fit a temperature and the score below which a prediction is
rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import SPACED, Texts, Words, map_texts, sums

#: Hash rows, width of an embedding, lengths of subwords.
ROWS, WIDTH, LENGTHS = 1 << 14, 16, (2, 3, 4)
#: Labelled texts that training may read in all, shared evenly by the languages; every language has one at least.
SAMPLE = 6000
#: Share of right answers that accepted predictions reach on the part kept apart.
PRECISION = 0.98
UNDETERMINED = "und"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def subwords(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash rows of the subwords of all distinct words, and where each word's begin."""
    found = words.distinct_array
    n = len(found)
    if not n:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    raw = found.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + n + 1]
    size = np.diff(offsets)
    # Every word as <word>, side by side.
    at = np.concatenate([[0], np.cumsum(size + 2)])
    marked = np.full(at[-1], ord("<"), np.uint64)
    marked[at[1:] - 1] = ord(">")
    origin = np.repeat(offsets[:-1] - (at[:-1] + 1), size)
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = inner[at[1:] - 1] = False
    place = np.flatnonzero(inner)
    marked[place] = np.frombuffer(raw.buffers()[2], np.uint8)[place + origin]
    word = np.repeat(np.arange(n), size + 2)
    rows, owner = [], []
    for length in LENGTHS:
        if len(marked) < length:
            continue
        h = np.full(len(marked) - length + 1, length, np.uint64)
        for j in range(length):
            h = (h ^ marked[j : len(marked) - length + 1 + j]) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
        whole = word[: len(h)] == word[length - 1 :]
        rows.append((h[whole] & np.uint64(ROWS - 1)).astype(np.int64))
        owner.append(word[: len(h)][whole])
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return rows[order], np.searchsorted(owner[order], np.arange(n + 1))


def has_letter(texts: Texts) -> np.ndarray:
    ascii_letter = sums(_ASCII_LETTER[texts.data].astype(np.int8), texts.at) > 0
    for i in np.flatnonzero(~ascii_letter & (sums((texts.data >= 0x80).astype(np.int8), texts.at) > 0)):
        ascii_letter[i] = any(c.isalpha() for c in texts.one(i).decode("utf-8", "replace"))
    return ascii_letter


@dataclass(frozen=True)
class LanguageModel:
    """``table`` has a vector for each hash row: a text's logits are their mean times ``weights`` plus ``bias``.

    The vectors are embeddings, or logits where languages are fewer than an
    embedding is wide: subwords of a slice of text then take less memory.
    """

    languages: list[str]
    table: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def predict(self, texts: Texts) -> tuple[list[str], np.ndarray]:
        """Language and calibrated probability of each text."""
        known = has_letter(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        words = texts.lower().words(SPACED)
        rows, at = subwords(words)
        of_word, n = sums(self.table[rows], at), np.diff(at).astype(np.float64)
        total = sums(of_word[words.codes], words.at)
        count = sums(n[words.codes], words.at) if len(n) else np.zeros(len(texts))
        means = total / np.maximum(count, 1)[:, None]
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        # As many texts at once as have a few million logits, whatever the number of languages.
        step = max(1, (1 << 22) // len(self.languages))
        for i in range(0, len(texts), step):
            p = softmax((means[i : i + step] @ self.weights + self.bias) / self.temperature)
            best[i : i + step], score[i : i + step] = p.argmax(axis=1), p.max(axis=1)
        names = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        return names, np.where(known, score, 0.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64) -> LanguageModel:
    """Fit a model to texts given as hash rows and their counts; every fifth text is kept apart."""
    rng = np.random.default_rng(7)
    k = len(languages)
    embeddings = rng.normal(0, 0.1, (ROWS, WIDTH)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (WIDTH, k)).astype(np.float32), np.zeros(k, np.float32)
    squares = [np.full(x.shape, 1e-8, np.float32) for x in (embeddings, weights, bias)]
    order = rng.permutation(len(features))
    apart, used = order[::5], order[np.arange(len(order)) % 5 != 0]
    if not len(used):
        used = order

    def means(chosen: np.ndarray) -> np.ndarray:
        x = np.zeros((len(chosen), ROWS), np.float32)
        for i, j in enumerate(chosen):
            rows, counts = features[j]
            x[i, rows] = counts / max(1, counts.sum())
        return x

    for epoch in range(epochs):
        rng.shuffle(used)
        for start in range(0, len(used), batch):
            chosen = used[start : start + batch]
            x = means(chosen)
            h = x @ embeddings
            d = softmax(h @ weights + bias)
            d[np.arange(len(chosen)), labels[chosen]] -= 1
            d /= len(chosen)
            gradients = (x.T @ (d @ weights.T), h.T @ d, d.sum(axis=0))
            for value, square, g in zip((embeddings, weights, bias), squares, gradients, strict=True):
                square += g * g
                value -= 0.3 * (1 - epoch / epochs) * g / np.sqrt(square)
    table, weights, bias = (x.astype(np.float64) for x in (embeddings, weights, bias))
    if k <= WIDTH:
        table, weights = table @ weights, np.eye(k)
    if not len(apart):
        return LanguageModel(languages, table, weights, bias)
    logits = np.concatenate([means(apart[i : i + batch]) @ table @ weights + bias for i in range(0, len(apart), batch)])
    truth = labels[apart]
    temperatures = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    by_score = np.argsort(-score)
    precision = np.cumsum(right[by_score]) / np.arange(1, len(right) + 1)
    enough = np.flatnonzero(precision >= PRECISION)
    threshold = float(score[by_score][enough[-1]]) if len(enough) else 1.0
    return LanguageModel(languages, table, weights, bias, temperature, threshold)


def fit(documents: DataFrame, may_learn: Column, label: str = "lang") -> LanguageModel:
    """Train on labelled texts for which ``may_learn`` holds, the first of each language by a hash of doc_id and text.

    A language has an even share of SAMPLE, one text at least, so that all
    languages can be predicted and SAMPLE or as many texts as there are languages
    are read. Rows of one language, doc_id and text count once, however many
    there are.
    """
    usable = documents.where(may_learn & F.col(label).isNotNull()).select(
        F.col(label).alias("_label"), F.xxhash64(F.lit("language"), "doc_id", "text").alias("_draw"), "text"
    )
    n = usable.select("_label").distinct().count()
    if not n:
        return LanguageModel([], np.zeros((ROWS, 0)), np.zeros((0, 0)), np.zeros(0))
    by_draw = Window.partitionBy("_label").orderBy("_draw")
    first = usable.groupBy("_label", "_draw").agg(F.count(F.lit(1))).select("_label", "_draw", F.row_number().over(by_draw).alias("nth"))
    first = first.where(F.col("nth") <= max(1, SAMPLE // n)).select("_label", "_draw")
    # Bounded: a number and a label for each text of the sample.
    chosen = usable.join(F.broadcast(first), ["_label", "_draw"]).groupBy("_label", "_draw").agg(F.max("text").alias("text"))

    def features(batch: pa.RecordBatch) -> list[pa.Array]:
        words = Texts.of(batch.column("text")).lower().words(SPACED)
        rows, at = subwords(words)
        out = []
        for i in range(len(batch)):
            code, many = np.unique(words.codes[words.at[i] : words.at[i + 1]], return_counts=True)
            sizes = at[code + 1] - at[code]
            mine = np.concatenate([rows[at[c] : at[c + 1]] for c in code]) if len(code) else np.zeros(0, np.int64)
            count = np.bincount(mine, np.repeat(many, sizes), minlength=1)
            found = np.flatnonzero(count)
            out.append({"rows": found.astype(np.int32), "counts": count[found].astype(np.float32)})
        return [pa.array(out, pa.struct([("rows", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))]))]

    # Bounded: the texts of the sample, of at most ROWS numbers each.
    found = map_texts(chosen, features, "f struct<rows: array<int>, counts: array<float>>", ["_label", "_draw"]).toArrow()
    found = found.sort_by([("_draw", "ascending"), ("_label", "ascending")])
    languages = sorted(set(found.column("_label").to_pylist()))
    number = {name: i for i, name in enumerate(languages)}
    labels = np.array([number[x] for x in found.column("_label").to_pylist()], np.int64)
    both = found.column("f").combine_chunks()
    rows, counts = both.field("rows"), both.field("counts")
    at, flat, many = rows.offsets.to_numpy(), rows.values.to_numpy(), counts.values.to_numpy()
    texts = [(flat[a:b], many[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return train(texts, labels, languages)


def identify(documents: DataFrame, model: LanguageModel, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` with lang_pred, score and accepted for every row of ``documents``.

    ``und`` with score 0 for null and for texts without a letter, and for all if
    nothing was learned; ``accepted`` says whether the score reaches the model's
    rejection threshold. Repeated rows get equal results; whole texts are read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        names, score = shared.value.predict(Texts.of(batch.column("text")))
        accepted = (score >= shared.value.threshold) & (score > 0)
        return [pa.array(names, pa.string()), pa.array(score), pa.array(accepted)]

    return map_texts(documents, work, "lang_pred string, score double, accepted boolean", keep)
