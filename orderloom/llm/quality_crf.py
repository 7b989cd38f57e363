"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own measures, those of its
neighbours and the label before. Forward-backward marginals of a document,
weighted by line length, make its quality; a logistic curve fitted on the
training documents turns that into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.batches import SPACED, Texts, map_texts, sums
from orderloom.llm.spread import unit

#: Labelled documents that training may read, of each at most so many lines: longer ones give RUNS even runs of lines.
SAMPLE, SAMPLE_LINES, RUNS = 4000, 500, 5

_KINDS = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 sign, 6 beyond ASCII
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 1, 2, 3
_KINDS[[9, 11, 12, 13, 32]] = 4
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 5
_KINDS[128:] = 6
MEASURES = 10


def lines(texts: Texts) -> tuple[Texts, np.ndarray]:
    """The lines of all texts side by side, and where each text's begin; an empty text is one empty line."""
    breaks = np.flatnonzero(texts.data == 10)
    # A line begins at a text's start and after each line break, which belongs to the line before it.
    owner_at = np.searchsorted(breaks, texts.at) + np.arange(len(texts.at))
    starts = np.empty(owner_at[-1], np.int64)
    opens = np.zeros(len(starts), bool)
    opens[owner_at[:-1]] = True
    starts[opens], starts[~opens] = texts.at[:-1], breaks + 1
    return Texts(texts.data, np.append(starts, len(texts.data))), owner_at


def measures(found: Texts, owner_at: np.ndarray) -> np.ndarray:
    """A row of MEASURES numbers per line: shares of kinds of characters, repeats, lengths."""
    n = len(found)
    kind = _KINDS[found.data]
    size = np.diff(found.at)
    share = np.empty((n, MEASURES))
    for k in range(1, 7):
        share[:, k - 1] = sums((kind == k).astype(np.int8), found.at)
    letters = np.maximum(share[:, 0] + share[:, 1], 1)
    capitals = share[:, 0] / letters
    share[:, :6] /= np.maximum(size, 1)[:, None]
    words = found.words(SPACED)
    same = np.zeros(len(words.starts), np.int8)
    if len(same) > 1:
        same[1:] = words.codes[1:] == words.codes[:-1]
    first = words.at[:-1][words.at[:-1] < len(same)]
    same[first] = 0
    count = np.maximum(words.counts, 1)
    share[:, 6] = sums(same, words.at) / count
    share[:, 7] = capitals
    share[:, 8] = np.log1p(size) / 8
    share[:, 9] = np.minimum(size / count, 40) / 10
    return share


def features(share: np.ndarray, owner_at: np.ndarray) -> np.ndarray:
    """The measures of each line and their roots, and those of the lines before and after."""
    own = np.concatenate([share, np.sqrt(share)], axis=1)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[owner_at[:-1]] = 0
    after[owner_at[1:] - 1] = 0
    edges = np.zeros((len(own), 2))
    edges[owner_at[:-1], 0] = 1
    edges[owner_at[1:] - 1, 1] = 1
    return np.concatenate([own, before, after, edges, np.ones((len(own), 1))], axis=1)


def _product(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row the product of 2 x 2 matrices, scaled."""
    r = np.stack(
        [
            p[:, 0] * q[:, 0] + p[:, 1] * q[:, 2],
            p[:, 0] * q[:, 1] + p[:, 1] * q[:, 3],
            p[:, 2] * q[:, 0] + p[:, 3] * q[:, 2],
            p[:, 2] * q[:, 1] + p[:, 3] * q[:, 3],
        ],
        axis=1,
    )
    return r / r.max(axis=1, keepdims=True)


def forward_backward(node: np.ndarray, links: np.ndarray, owner_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of label 1 per line and of each pair of labels per line and the one before.

    ``node`` is the log-odds of label 1, ``links`` the 2 x 2 log weights of
    neighbours. Products of 2 x 2 matrices over growing stretches replace the
    walk along each document: a document's first line has a matrix of equal rows,
    which forgets all that came before, so all documents are done at once in
    as many steps as the longest has binary digits.
    """
    n = len(node)
    first, last = owner_at[:-1], owner_at[1:] - 1
    p1 = 1 / (1 + np.exp(-np.clip(node, -30, 30)))
    phi = np.stack([1 - p1, p1], axis=1)
    weight = np.exp(links)
    step = np.stack([weight[0, 0] * phi[:, 0], weight[0, 1] * phi[:, 1], weight[1, 0] * phi[:, 0], weight[1, 1] * phi[:, 1]], axis=1)
    step /= step.max(axis=1, keepdims=True)
    ahead = np.empty_like(step)
    ahead[:-1] = step[1:]
    step[first] = np.concatenate([phi[first], phi[first]], axis=1)
    ahead[last] = 1.0
    longest = int(np.diff(owner_at).max(initial=1))
    d = 1
    while d < longest:
        new = step.copy()
        new[d:] = _product(step[:-d], step[d:])
        step = new
        new = ahead.copy()
        new[:-d] = _product(ahead[:-d], ahead[d:])
        ahead = new
        d *= 2
    alpha = step[:, :2] / step[:, :2].sum(axis=1, keepdims=True)
    beta = np.stack([ahead[:, 0] + ahead[:, 1], ahead[:, 2] + ahead[:, 3]], axis=1)
    both = alpha * beta
    marginal = both[:, 1] / both.sum(axis=1)
    pairs = np.zeros((n, 4))
    inner = np.ones(n, bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    right = phi[i] * beta[i]
    pairs[i] = (alpha[i - 1][:, :, None] * weight[None] * right[:, None, :]).reshape(-1, 4)
    pairs[i] /= pairs[i].sum(axis=1, keepdims=True)
    return marginal, pairs


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    links: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, share: np.ndarray, size: np.ndarray, owner_at: np.ndarray) -> np.ndarray:
        marginal, _ = forward_backward(features(share, owner_at) @ self.weights, self.links, owner_at)
        size = size + 1.0
        return sums(marginal * size, owner_at) / sums(size, owner_at)

    def score(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Probability that a text is good, and its number of lines."""
        if not len(texts):
            return np.zeros(0), np.zeros(0, np.int64)
        found, owner_at = lines(texts)
        raw = self.raw(measures(found, owner_at), np.diff(found.at), owner_at)
        return self.probability(raw), np.diff(owner_at)

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * _logit(raw) + self.offset)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def train(
    share: np.ndarray, size: np.ndarray, owner_at: np.ndarray, good: np.ndarray, good_share: float | None = None, steps: int = 150
) -> QualityModel:
    """Maximum likelihood by Adam: every line of a document has the document's label.

    ``good_share``: share of good documents among all labelled ones, to which the
    probabilities are fitted (null: that of the sample).
    """
    x = features(share, owner_at)
    count = np.diff(owner_at)
    label = np.repeat(good.astype(np.float64), count)
    # Documents weigh the same whatever their length, and both labels the same in all.
    per_doc = np.where(good > 0, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
    weight = np.repeat(per_doc / count, count)
    inner = np.ones(len(x), bool)
    inner[owner_at[:-1]] = False
    observed_links = np.zeros(4)
    observed_links[0] = weight[inner & (label == 0)].sum()
    observed_links[3] = weight[inner & (label == 1)].sum()
    params = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        marginal, pairs = forward_backward(x @ params[:-4], params[-4:].reshape(2, 2), owner_at)
        g = np.concatenate([x.T @ (weight * (marginal - label)), (weight[:, None] * pairs)[inner].sum(axis=0) - observed_links])
        g += np.concatenate([1e-5 * params[:-4], 1e-2 * params[-4:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-10)
    model = QualityModel(params[:-4], params[-4:].reshape(2, 2))
    if not 0 < good.sum() < len(good):
        return model
    # Platt's curve, with its targets kept off 0 and 1.
    z = _logit(model.raw(share, size, owner_at))
    n1, n0 = good.sum(), len(good) - good.sum()
    target = np.where(good > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    share_now = n1 / (n1 + n0)
    rate = share_now if good_share is None else good_share
    each = np.where(good > 0, rate / share_now, (1 - rate) / (1 - share_now))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = _logistic(a * z + b)
        r, w = each * (p - target), each * p * (1 - p) + 1e-6
        h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(h, [(r * z).sum() + 1e-3 * a, r.sum()])
        a, b = a - da, b - db
    return QualityModel(model.weights, model.links, float(a), float(b))


def sample_lines(n: int) -> np.ndarray:
    """The lines of a document of ``n`` lines that training reads: all, or even runs."""
    if n <= SAMPLE_LINES:
        return np.arange(n)
    run = SAMPLE_LINES // RUNS
    starts = np.arange(RUNS) * (n - run) // (RUNS - 1)
    return (starts[:, None] + np.arange(run)).ravel()


def fit(documents: DataFrame, labels: DataFrame, may_learn: Column) -> QualityModel:
    """Train on at most SAMPLE labelled documents for which ``may_learn`` (of doc_id) holds, chosen by doc_id.

    A document of more than SAMPLE_LINES lines gives as many of them, in RUNS
    runs at even distances, with the measures they have in the whole text. Of
    rows with one doc_id the one whose text has the least hash is read. Without
    labels the model says one half of everything.
    """
    known = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    n = known.agg(F.count(F.lit(1)), F.sum("quality")).first()
    # Both labels get their half of the sample, so that a rare one is learned.
    chosen = [
        known.where(F.col("quality") == q)
        .select("doc_id", F.col("quality").alias("_quality"))
        .orderBy(unit(F.concat_ws(" ", F.lit("quality"), F.col("doc_id"))), "doc_id")
        .limit(SAMPLE // 2)
        for q in (0, 1)
    ]
    chosen = chosen[0].unionByName(chosen[1]).groupBy("doc_id").agg(F.min("_quality").alias("_quality"))
    # Bounded: at most SAMPLE rows of two numbers, then one text for each.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("_quality").alias("_quality"), F.min_by("text", F.xxhash64("text")).alias("text"))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        found, owner_at = lines(Texts.of(batch.column("text")))
        table = np.column_stack([np.diff(found.at), measures(found, owner_at)])
        chosen_lines = [a + sample_lines(b - a) for a, b in zip(owner_at[:-1], owner_at[1:], strict=True)]
        return [pa.array([table[i].ravel() for i in chosen_lines], pa.list_(pa.float64()))]

    rows = map_texts(texts, work, "numbers array<double>", ["doc_id", "_quality"]).toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])
    if not rows.num_rows:
        return QualityModel(np.zeros(6 * MEASURES + 3), np.zeros((2, 2)))
    tables = [np.asarray(x.values.to_numpy()).reshape(-1, MEASURES + 1) for x in rows.column("numbers")]
    table = np.concatenate(tables)
    owner_at = np.concatenate([[0], np.cumsum([len(t) for t in tables])])
    return train(table[:, 1:], table[:, 0], owner_at, rows.column("_quality").to_numpy().astype(np.int64), n[1] / n[0])


def rate(documents: DataFrame, model: QualityModel, keep=("doc_id",), threshold: float = 0.7) -> DataFrame:
    """Columns ``keep`` with score, predicted (1 if score >= threshold) and n_lines for every row.

    Null counts as empty, an empty text is one empty line and is scored like any
    other. Repeated rows get equal scores; an empty table has an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        score, n = shared.value.score(Texts.of(batch.column("text")))
        return [pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(n)]

    return map_texts(documents, work, "score double, predicted int, n_lines bigint", keep)
