"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

A pattern is a window of words of a benchmark item. The search looks at blocks
of two words: a table says how far the next possible end of a pattern is from
each block, and most positions are skipped. Where the distance is zero, the last
words select a bucket of patterns and a hash of the words before them a place in
it, so that a bucket of a common pair of words costs no more than another; a
comparison of all words confirms. Many texts are searched side by side, one cursor per stretch of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.batches import ALPHANUMERIC, Texts, Words, map_texts
from orderloom.scratch import new_scratch, written

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text that are searched for in one pass; larger benchmarks take several.
#: The tables of a pass take up to about 25 times as many bytes, on the driver and in every worker.
PASS_BYTES = 8 << 20
#: Words that one cursor searches.
_STRETCH = 2048
_SPANS, _ITEMS = "_found_spans", "_found_items"


@dataclass(frozen=True)
class _Table:
    """Patterns of ``length`` words, as numbers of the vocabulary (0: any other word)."""

    length: int
    patterns: np.ndarray
    items: np.ndarray  # flat: items of pattern i are items[item_at[i]:item_at[i+1]]
    item_at: np.ndarray
    block: int
    shift_keys: np.ndarray
    shifts: np.ndarray
    bucket_keys: np.ndarray
    places: np.ndarray  # bucket and prefix hash of each pattern, ascending

    @classmethod
    def of(cls, windows: np.ndarray, items: np.ndarray, base: int) -> _Table:
        """Of the rows of ``windows``, which belong to ``items`` and may repeat."""
        length = windows.shape[1]
        block = min(2, length)
        bucket_keys, bucket = np.unique(_block(windows, length - 1, block, base), return_inverse=True)
        places = _place(bucket, _prefix(windows.T[: length - block], len(windows)))
        order = np.lexsort((items, places))
        windows, items, places = windows[order], items[order], places[order]
        # Equal windows are one pattern; two that only share their place are compared here.
        new = np.ones(len(windows), bool)
        new[1:] = (places[1:] != places[:-1]) | (windows[1:] != windows[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        ordered = windows[first]
        # Distance from each block's last place in any pattern to the pattern's end.
        ends = range(block - 1, length)
        keys = np.concatenate([_block(ordered, e, block, base) for e in ends])
        distance = np.concatenate([np.full(len(ordered), length - 1 - e, np.int16) for e in ends])
        by = np.lexsort((distance, keys))
        shift_keys, least = np.unique(keys[by], return_index=True)
        return cls(
            length,
            ordered,
            items,
            np.append(first, len(items)),
            block,
            shift_keys,
            distance[by][least],
            bucket_keys,
            places[first],
        )

    def search(self, words: np.ndarray, at: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all occurrences, and which pattern each is of."""
        m, far = self.length, self.length - self.block + 1
        n = np.diff(at)
        per_text = -(-np.maximum(n - m + 1, 0) // _STRETCH)
        text = np.repeat(np.arange(len(n)), per_text)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        cursor = at[text] + nth * _STRETCH + m - 1
        stop = np.minimum(cursor + _STRETCH, at[text + 1])
        found, which = [], []
        while len(cursor):
            key = words[cursor] if self.block == 1 else words[cursor - 1] * base + words[cursor]
            place = np.minimum(np.searchsorted(self.shift_keys, key), len(self.shift_keys) - 1)
            shift = np.where(self.shift_keys[place] == key, self.shifts[place], far)
            ending = cursor[shift == 0]
            if len(ending):
                first, pattern = self._confirm(words, ending, key[shift == 0])
                found.append(first)
                which.append(pattern)
            cursor = cursor + np.maximum(shift, 1)
            alive = cursor < stop
            cursor, stop = cursor[alive], stop[alive]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(which)

    def _confirm(self, words: np.ndarray, ending: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compare with the patterns of the suffix's bucket that have the prefix hash: seldom more than one."""
        bucket, begin = np.searchsorted(self.bucket_keys, key), ending - self.length + 1
        prefix = _prefix([words[begin + j] for j in range(self.length - self.block)], len(ending))
        place = _place(bucket, prefix)
        low, high = np.searchsorted(self.places, place), np.searchsorted(self.places, place, side="right")
        firsts, patterns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(int((high - low).max())):
            has = high - low > k
            pattern, first = low[has] + k, begin[has]
            for j in range(self.length):
                same = words[first + j] == self.patterns[pattern, j]
                pattern, first = pattern[same], first[same]
            firsts.append(first)
            patterns.append(pattern)
        return np.concatenate(firsts), np.concatenate(patterns)


def _block(patterns: np.ndarray, end: int, block: int, base: int) -> np.ndarray:
    last = patterns[:, end].astype(np.int64)
    return last if block == 1 else patterns[:, end - 1].astype(np.int64) * base + last


def _prefix(columns: Sequence[np.ndarray], n: int) -> np.ndarray:
    """32-bit hash of the words before the last block, given as columns."""
    h = np.zeros(n, np.uint64)
    for column in columns:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h & np.uint64(0xFFFFFFFF)


def _place(bucket: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    return (bucket.astype(np.uint64) << np.uint64(32)) | prefix


class Patterns:
    """Windows of benchmark items, in one table per length."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        texts = Texts.of(pa.array([text for _, text in items], pa.string())).lower()
        words = texts.words(ALPHANUMERIC)
        self.vocabulary: dict[bytes, int] = {}
        numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words.distinct]
        flat = np.array(numbers, np.int32)[words.codes] if numbers else np.zeros(0, np.int32)
        self.base = len(self.vocabulary) + 1
        n = np.diff(words.at)
        self.tables = []
        for length in np.unique(np.minimum(n[n > 0], window)).tolist():
            whole = np.flatnonzero(n == length if length < window else n >= window)
            many = n[whole] - length + 1
            start = np.repeat(words.at[whole], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            windows = np.stack([flat[start + j] for j in range(length)], axis=1)
            self.tables.append(_Table.of(windows, np.repeat(whole, many), self.base))

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every word whether it is hit; text and item of every pair that occurs."""
        known = self.vocabulary
        numbers = np.fromiter((known.get(w, 0) for w in words.distinct), np.int64, len(words.distinct_array))
        flat = numbers[words.codes] if len(numbers) else np.zeros(0, np.int64)
        edges = np.zeros(len(flat) + 1, np.int64)
        texts, items = [], []
        for table in self.tables:
            first, pattern = table.search(flat, words.at, self.base)
            np.add.at(edges, first, 1)
            np.add.at(edges, first + table.length, -1)
            many = table.item_at[pattern + 1] - table.item_at[pattern]
            text = np.searchsorted(words.at, first, side="right") - 1
            texts.append(np.repeat(text, many))
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items.append(table.items[np.repeat(table.item_at[pattern], many) + offset])
        none = np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate([none, *texts]), np.concatenate([none, *items])]), axis=1)
        return np.cumsum(edges[:-1]) > 0, pairs[0], pairs[1]


def _passes(benchmark: DataFrame) -> Iterator[list[tuple[str, str]]]:
    """The items in groups of about PASS_BYTES, so that no more is on the driver or broadcast at once."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text").where(
        F.col("text").isNotNull()
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // PASS_BYTES)
    for i in range(n):
        group = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i) if n > 1 else items
        rows = sorted((r["name"], r["text"]) for r in group.collect())
        if rows:
            yield rows


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` of every document and what it shares with the benchmark.

    Added: ``n_words``; ``n_hit`` (words inside any occurrence of a window);
    ``items``, the item_ids with occurring windows, distinct, as text in order;
    ``contaminated`` (n_hit > 0). A null or empty text has no words and is
    clean; items without words are never found; items with one item_id count as
    one; a null item_id counts as ''. An empty benchmark finds nothing.
    """
    spark = documents.sparkSession
    keep, with_text = list(keep), list(dict.fromkeys([*keep, "text"]))
    parts = _passes(benchmark)
    rows, later = next(parts, []), next(parts, None)
    result = _one_pass(documents, rows, window, keep if later is None else with_text, False)
    while later is not None:
        # Another part of the benchmark: what was found so far travels with the texts.
        so_far = result.select(*with_text, F.col("hit_spans").alias(_SPANS), F.col("items").alias(_ITEMS))
        so_far = written(spark, so_far, new_scratch(spark, "contamination"))
        rows, later = later, next(parts, None)
        result = _one_pass(so_far, rows, window, keep if later is None else with_text, True)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return result.select(*keep, "n_words", n_hit.alias("n_hit"), "items", (F.size("hit_spans") > 0).alias("contaminated"))


def _one_pass(
    documents: DataFrame, rows: list[tuple[str, str]], window: int, keep: Sequence[str], again: bool
) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(Patterns(rows, window))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        patterns: Patterns = shared.value
        texts = Texts.of(batch.column("text")).lower()
        words = texts.words(ALPHANUMERIC)
        hit, text, item = patterns.hits(words)
        names = [{patterns.names[i] for i in item[a:b]} for a, b in _ranges(text, len(texts))]
        if again:
            spans, n_spans = batch.column(_SPANS), pc.list_value_length(batch.column(_SPANS)).to_numpy()
            origin = np.repeat(words.at[:-1], n_spans)
            edges = np.zeros(len(hit) + 1, np.int64)
            np.add.at(edges, origin + pc.struct_field(spans.flatten(), "start").to_numpy(), 1)
            np.add.at(edges, origin + pc.struct_field(spans.flatten(), "end").to_numpy(), -1)
            hit |= np.cumsum(edges[:-1]) > 0
            names = [a.union(b) for a, b in zip(names, batch.column(_ITEMS).to_pylist(), strict=True)]
        # Hit words as spans; a span ends with its text.
        first = hit.copy()
        first[1:] &= ~hit[:-1]
        bounds = words.at[:-1][words.at[:-1] < len(hit)]
        first[bounds] = hit[bounds]
        last = hit.copy()
        last[:-1] &= ~hit[1:]
        bounds = words.at[1:][words.at[1:] > 0] - 1
        last[bounds] = hit[bounds]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        at = np.searchsorted(start, words.at)
        origin = np.repeat(words.at[:-1], np.diff(at))
        spans = pa.StructArray.from_arrays([pa.array(start - origin), pa.array(end - origin)], ["start", "end"])
        return [
            pa.array(words.counts),
            pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans),
            pa.array([sorted(x) for x in names], pa.list_(pa.string())),
        ]

    schema = "n_words bigint, hit_spans array<struct<start: bigint, end: bigint>>, items array<string>"
    return map_texts(documents, work, schema, keep, [_SPANS, _ITEMS] if again else [])


def _ranges(text: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    at = np.searchsorted(text, np.arange(n + 1))
    return zip(at[:-1].tolist(), at[1:].tolist(), strict=True)


def digest(items: str = "items"):
    """sha256 of the item_ids, comma-joined."""
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)
