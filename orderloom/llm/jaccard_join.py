"""Texts whose sets of word shingles are similar, as a join in the Jaccard metric space.

Jaccard distance is a metric. Pivots split a region into Voronoi cells; by the
triangle inequality a document can only be close to documents of its own cell and
of cells whose pivot is hardly farther than its own, so documents near a boundary
are also given to those cells and every cell is joined alone, by the same rule
again. Two rules keep work off: distances to a pivot that differ by more than the
radius exclude a pair, and pairs that are already connected need no look.

Regions come from shingles: two similar sets share one of their first shingles in
any common order, so documents that share none are never in one region. The
order puts shingles first that occur once: only sets that are shared for the most
part, as near copies are, meet at all. Sets are compared as 64-bit hashes of their shingles; documents with equal
sets are one class throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.batches import SPACED, Texts, map_batches, map_texts, pieces, send_package
from orderloom.llm.components import connected_components
from orderloom.llm.spread import KeyFilter, attach, most_frequent
from orderloom.scratch import new_scratch, written

SHINGLE, PERCENT = 5, 75
#: Shingles that are ranked by frequency: the most frequent ones. Of others, filters tell the power of two.
FREQUENT = 1 << 17
#: Shingles are counted by so many bits of their hash, in stretches of so many at once.
COUNT_BITS, _STRETCH = 36, 1 << 21
#: The first bits of a hash say which part of the counts it belongs to.
_PART_BITS = 12
#: Bits of a filter of shingles that occur four times or more often.
_LEVEL_BITS = 29
#: Bytes of text that are hashed at once: a word needs about a hundred bytes while it is.
SLICE_BYTES = 3 << 20


@dataclass(frozen=True)
class Limits:
    """A region of at most ``hashes`` and ``classes`` is joined in one task.

    A larger one has about ``pivots`` pivots in its first round and twice as many
    in each of ``rounds``; pivots of ``pivot_bytes`` are broadcast at once. The
    regions of at most ``known`` classes are known to all tasks that hash their sets.
    """

    hashes: int = 1 << 20
    classes: int = 8192
    pivots: int = 16
    rounds: int = 6
    pivot_bytes: int = 32 << 20
    known: int = 1 << 22


_MAY_GO = "_may_go"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashed_sets(texts: Texts, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in order, side by side, and where each text's begin."""
    words = texts.lower().words(SPACED)
    h, n = words.hashes(), words.counts
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    # h[i] covers the words from i on, as many as a shingle has or the text still holds.
    longest = int(min(width, n.max(initial=0)))
    left = np.repeat(words.at[1:], n) - np.arange(len(h))
    out, total = h.copy(), h.copy()
    for j in range(1, longest):
        further = np.zeros_like(h)
        further[:-j] = h[j:]
        total = total * _STEP + further
        out = np.where(left > j, total, out)
    per_text = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    size = np.minimum(n, width)
    first = np.arange(len(h)) - np.repeat(words.at[:-1], n)
    used = first < np.repeat(per_text, n)
    owner = np.repeat(np.arange(len(n)), per_text)
    value = _mixed(out[used] + np.repeat(size, per_text).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)).view(np.int64)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(n) + 1))


def shingle_sets(
    documents: DataFrame,
    width: int = SHINGLE,
    keep: Sequence[str] = ("doc_id",),
    where: Callable[[pa.RecordBatch], pa.Array] | None = None,
) -> DataFrame:
    """Columns ``keep``, n_shingles, class (hash of the set, null if empty) and shingles (sorted hashes)."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        value, at = hashed_sets(Texts.of(batch.column("text")), width)
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value))
        return [pa.array(np.diff(at)), _classes(value, at), lists]

    schema = "n_shingles bigint, class bigint, shingles array<bigint>"
    return map_texts(documents, work, schema, keep, most=SLICE_BYTES, where=where)


def set_classes(
    documents: DataFrame,
    width: int = SHINGLE,
    keep: Sequence[str] = ("doc_id",),
    where: Callable[[pa.RecordBatch], pa.Array] | None = None,
) -> DataFrame:
    """Columns ``keep`` and class, as ``shingle_sets`` has them, of the rows that ``where`` wants."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        return [_classes(*hashed_sets(Texts.of(batch.column("text")), width))]

    return map_texts(documents, work, "class bigint", keep, most=SLICE_BYTES, where=where)


def _classes(value: np.ndarray, at: np.ndarray) -> pa.Array:
    kinds = [
        xxhash.xxh3_64_intdigest(value[a:b]) - (1 << 63) if b > a else None
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
    ]
    return pa.array(kinds, pa.int64())


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    return column.values.to_numpy()[at[0] : at[-1]], (at - at[0]).astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of each range, one range after another."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


@dataclass(frozen=True)
class Order:
    """A common order of all shingles: by the power of two in their frequency, then by hash.

    Filter k holds what occurs 2 ** (k + 1) times or more often; all tables have
    a bounded size. They are exact enough to keep most of what
    documents share by chance out of their first shingles; the result is the
    same for any order.
    """

    filters: tuple[KeyFilter, ...]
    frequent: np.ndarray
    rank: np.ndarray

    def level(self, value: np.ndarray) -> np.ndarray:
        key = value & ((1 << COUNT_BITS) - 1)
        level = np.zeros(len(key), np.int64)
        left = np.arange(len(key))
        for held in self.filters:
            left = left[held.may_hold(key[left])]
            level[left] += 1
        if len(self.frequent):
            place = np.minimum(np.searchsorted(self.frequent, key), len(self.frequent) - 1)
            level = np.where(self.frequent[place] == key, self.rank[place], level)
        return level


def varints(values: np.ndarray) -> np.ndarray:
    """Numbers as bytes of seven bits each, the lowest first; the last byte of a number is below 128."""
    values = values.astype(np.uint64)
    size, most = np.ones(len(values), np.int64), int(values.max(initial=0))
    for bits in range(7, most.bit_length(), 7):
        size += values >= np.uint64(1 << bits)
    first = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for j in range(int(size.max(initial=0))):
        some = size > j
        more = (size[some] > j + 1).astype(np.uint8) << 7
        out[first[some] + j] = (values[some] >> np.uint64(7 * j)).astype(np.uint8) & 127 | more
    return out


def from_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in ``data`` and the place behind each."""
    ends = np.flatnonzero(data < 128) + 1
    size = np.diff(ends, prepend=0)
    first, values = ends - size, np.zeros(len(ends), np.int64)
    for j in range(int(size.max(initial=0))):
        some = size > j
        values[some] |= (data[first[some] + j] & 127).astype(np.int64) << (7 * j)
    return values, ends


def _binaries(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def _bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()).combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def packed_counts(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Different keys in order and their counts, a row for each part: steps from key to key take two or three bytes."""
    part = key >> (COUNT_BITS - _PART_BITS)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(key)]
    step = np.diff(key, prepend=0)
    step[starts] = key[starts] - (part[starts] << (COUNT_BITS - _PART_BITS))
    columns = []
    for numbers in (step, n):
        data = varints(numbers)
        ends = np.append(0, np.flatnonzero(data < 128) + 1)
        columns.append(_binaries(data, ends[np.append(starts, len(key))]))
    return pa.RecordBatch.from_arrays([pa.array(part[starts], pa.int64()), *columns], names=["part", "steps", "counts"])


def summed_counts(part: int, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one part that all its rows together count more than once, in order, and how often."""
    data, at = _bytes(rows.column("steps"))
    step, ends = from_varints(data)
    first = np.searchsorted(ends, at[:-1], side="right")
    upto = np.cumsum(step)
    before = upto[first] - step[first]
    key = upto - np.repeat(before, np.diff(np.append(first, len(step))))
    n = from_varints(_bytes(rows.column("counts"))[0])[0]
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    n = np.add.reduceat(n, starts)
    several = n > 1
    return key[starts][several] + (part << (COUNT_BITS - _PART_BITS)), n[several]


def shingle_order(documents: DataFrame, width: int, path: str, where: Callable[[pa.RecordBatch], pa.Array]) -> Order:
    """Count all shingles of the texts that ``where`` wants; texts that a task meets again right away count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def counted() -> pa.RecordBatch:
            return packed_counts(*np.unique(np.concatenate(held) & ((1 << COUNT_BITS) - 1), return_counts=True))

        for batch in batches:
            for piece in pieces(batch.filter(where(batch)), SLICE_BYTES):
                value, at = hashed_sets(Texts.of(piece.column("text")), width)
                for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                    kind = xxhash.xxh3_64_intdigest(value[a:b])
                    if b > a and kind not in seen:
                        seen.add(kind)
                        held.append(value[a:b])
                        size += b - a
                if size > _STRETCH:
                    yield counted()
                    held, size, seen = [], 0, set()
        if held:
            yield counted()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        now: int | None = None

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in summed_counts(now, pa.concat_tables(held))], names=["key", "n"])

        for batch in batches:
            part = batch.column("part").to_numpy()
            bounds = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if held and part[a] != now:
                    yield summed()
                    held = []
                now = int(part[a])
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield summed()

    packed = map_batches(documents.select("doc_id", "text"), count, "part bigint, steps binary, counts binary")
    dealt = packed.repartition("part").sortWithinPartitions("part")
    shared = written(documents.sparkSession, map_batches(dealt, add_up, "key bigint, n bigint"), path)
    frequent = most_frequent(shared, FREQUENT).toArrow().sort_by("key")
    # The place of the highest bit of n: the power of two in it.
    power = F.length(F.bin("n")) - 1
    of_power = {r["power"]: r["n"] for r in shared.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()}
    filters: list[KeyFilter] = []
    for k in range(1, max(of_power, default=1) + 1):
        n = sum(m for p, m in of_power.items() if p >= k)
        # What is left is among the most frequent.
        if filters and n <= FREQUENT:
            break
        keys = shared.where(F.col("n") >= 1 << k)
        filters.append(KeyFilter.of(keys, "key", n, _LEVEL_BITS if filters else KeyFilter.MOST_BITS))
    rank = np.log2(frequent.column("n").to_numpy()).astype(np.int64)
    return Order(tuple(filters), frequent.column("key").to_numpy(), rank)


def first_shingles(
    documents: DataFrame,
    order: Order,
    percent: int,
    width: int,
    keep: Sequence[str],
    where: Callable[[pa.RecordBatch], pa.Array],
) -> DataFrame:
    """Columns ``keep``, n_shingles, class and ``first``: the first shingles of the set, without those that are single.

    Sets that reach the threshold share at least percent / 100 of either, so the
    smallest shingle that they share is no later than this in both.
    """
    shared = documents.sparkSession.sparkContext.broadcast(order)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        value, at = hashed_sets(Texts.of(batch.column("text")), width)
        n = np.diff(at)
        level = shared.value.level(value)
        by = np.lexsort((value, level, np.repeat(np.arange(len(n)), n)))
        length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
        chosen = by[_ranges(at[:-1], length)]
        owner = np.repeat(np.arange(len(n)), length)
        several = level[chosen] > 0
        chosen, owner = chosen[several], owner[several]
        first_at = np.searchsorted(owner, np.arange(len(n) + 1))
        first = pa.ListArray.from_arrays(pa.array(first_at, pa.int32()), pa.array(value[chosen]))
        return [pa.array(n), _classes(value, at), first]

    schema = "n_shingles bigint, class bigint, first array<bigint>"
    return map_texts(documents, work, schema, keep, ("doc_id",), SLICE_BYTES, where)


class Region:
    """Sets that may be similar, joined in memory; links end in ``pairs`` as a spanning forest."""

    def __init__(self, value: np.ndarray, at: np.ndarray, group: np.ndarray, percent: int):
        self.size, self.percent = np.diff(at), percent
        n = len(self.size)
        _, code, count = np.unique(value, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), self.size)
        several = count[code] > 1
        code, owner = (np.cumsum(count > 1) - 1)[code[several]], owner[several]
        self.code, self.at = code, np.searchsorted(owner, np.arange(n + 1))
        order = np.argsort(code, kind="stable")
        self.owner = owner[order]
        self.post = np.searchsorted(code[order], np.arange(int((count > 1).sum()) + 1))
        self.group = np.unique(group, return_inverse=True)[1]
        self.pairs: list[tuple[int, int]] = []

    def distances(self, pivot: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of ``pivot`` to ``others``, and which of them are linked with it."""
        codes = self.code[self.at[pivot] : self.at[pivot + 1]]
        places = _ranges(self.post[codes], self.post[codes + 1] - self.post[codes])
        common = np.bincount(self.owner[places], minlength=len(self.size))[others]
        union = self.size[pivot] + self.size[others] - common
        return 1 - common / union, 100 * common >= self.percent * union

    def link(self, a: int, others: np.ndarray) -> None:
        for b in others.tolist():
            if self.group[a] != self.group[b]:
                self.pairs.append((a, b))
                self.group[self.group == self.group[b]] = self.group[a]

    def join(self, members: np.ndarray, depth: int = 0) -> None:
        """Find the links among ``members``, as far as they connect anything new."""
        if len(members) < 2 or (self.group[members] == self.group[members[0]]).all():
            return
        if len(members) > 64 and depth < 8:
            cells = self.cells(members)
            if cells is not None:
                for cell in cells:
                    self.join(cell, depth + 1)
                return
        self.compare(members)

    def cells(self, members: np.ndarray) -> list[np.ndarray] | None:
        """Voronoi cells with the documents that may be close to theirs; none if that splits little."""
        step = max(1, len(members) // 8)
        pivots = members[::step]
        distance = np.empty((len(pivots), len(members)))
        for i, p in enumerate(pivots):
            distance[i], linked = self.distances(p, members)
            self.link(p, members[linked])
        radius = 1 - self.percent / 100
        # Documents without anything in common with a pivot cannot be told apart by it.
        inside = distance <= distance.min(axis=0) + 2 * radius + 1e-9
        cells = [members[row] for row in inside]
        # Pairs to look at must become clearly fewer.
        return cells if sum(len(c) ** 2 for c in cells) <= 0.7 * len(members) ** 2 else None

    def compare(self, members: np.ndarray) -> None:
        """Every member in turn is a pivot for those that are not connected with it yet.

        Once all that were no pivots are connected with each other, nothing can be new.
        """
        radius = 1 - self.percent / 100
        waiting = np.ones(len(members), bool)
        known = np.zeros((0, len(members)))
        while True:
            left = np.flatnonzero(waiting)
            groups, count = np.unique(self.group[members[left]], return_counts=True)
            if len(groups) < 2:
                return
            rare = self.group[members[left]] != groups[count.argmax()]
            i = left[rare][0]
            waiting[i] = False
            near = waiting & (self.group[members] != self.group[members[i]])
            if len(known):
                near &= (np.abs(known - known[:, i : i + 1]) <= radius + 1e-9).all(axis=0)
            distance, linked = self.distances(members[i], members)
            self.link(members[i], members[near & linked])
            if len(known) < 32:
                known = np.concatenate([known, distance[None]])


def join_regions(regions: DataFrame, percent: int) -> DataFrame:
    """Links (a, b: classes) of all regions, each joined in one task.

    ``regions``: region, class, grp (classes with one grp are connected already)
    and shingles; a region is small enough for a task. Repeated rows do no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            region = table.column("region").to_numpy()
            # The last region may go on in the next batch.
            last = int(np.searchsorted(region, region[-1]))
            rest = table.slice(last)
            if last:
                yield _links(table.slice(0, last), percent)
        if rest is not None:
            yield _links(rest, percent)

    dealt = regions.select("region", "class", "grp", "shingles").repartition("region").sortWithinPartitions("region", "class")
    return map_batches(dealt, run, "a bigint, b bigint")


def _links(table: pa.Table, percent: int) -> pa.RecordBatch:
    region, kind = (table.column(c).to_numpy() for c in ("region", "class"))
    # A set may have come from several documents.
    new = np.append(True, (region[1:] != region[:-1]) | (kind[1:] != kind[:-1]))
    if not new.all():
        table = table.filter(pa.array(new))
    region, kind, group = (table.column(c).to_numpy() for c in ("region", "class", "grp"))
    value, at = _lists(table.column("shingles"))
    bounds = np.append(np.flatnonzero(np.append(True, region[1:] != region[:-1])), len(region))
    a, b = [], []
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start < 2:
            continue
        part = Region(value[at[start] : at[end]], at[start : end + 1] - at[start], group[start:end], percent)
        part.join(np.arange(end - start))
        for i, j in part.pairs:
            a.append(kind[start + i])
            b.append(kind[start + j])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _sizes(regions: DataFrame) -> DataFrame:
    n = F.col("n_shingles") if "n_shingles" in regions.columns else F.size("shingles")
    return regions.groupBy("region").agg(
        F.sum(n).alias("hashes"),
        F.count(F.lit(1)).alias("classes"),
        F.min("grp").alias("low"),
        F.max("grp").alias("high"),
    )


def _by_size(regions: DataFrame, limits: Limits, path: str) -> tuple[DataFrame, DataFrame, bool]:
    """Regions that fit a task, those that do not, and whether there are any of these; settled ones are left out.

    ``regions``: region, class, grp, and either shingles or their number, n_shingles.
    """
    spark = regions.sparkSession
    sizes = written(spark, _sizes(regions), path)
    is_large = (F.col("hashes") > limits.hashes) | (F.col("classes") > limits.classes)
    open_ = F.col("low") < F.col("high")
    large = sizes.where(is_large & open_).select("region")
    some = not large.isEmpty()
    done = sizes.where(~open_ | is_large).select("region")
    small = regions.join(done, "region", "left_anti")
    return small, regions.join(large, "region", "left_semi"), some


def _regroup(regions: DataFrame, links: DataFrame) -> DataFrame:
    """The regions with groups as the links connect them now."""
    old = regions.select(F.col("class").alias("a"), F.col("grp").alias("b")).distinct()
    found = connected_components(links.select("a", "b").unionByName(old))
    grp = F.coalesce("component", "grp").alias("grp")
    return regions.join(found.withColumnRenamed("node", "class"), "class", "left").select("region", "class", grp, "shingles")


def _pivot_distances(regions: DataFrame, pivots: DataFrame, percent: int, limits: Limits, path: str) -> DataFrame:
    """region, class, pivot, distance and linked for documents and pivots of a region that share a shingle."""
    spark = regions.sparkSession
    size = pivots.agg(F.sum(F.size("shingles") + 4)).first()[0] or 0
    n = max(1, -(-size * 8 // limits.pivot_bytes))
    for i in range(n):
        some = pivots.where(F.pmod(F.xxhash64("class", "region"), F.lit(n)) == i).toArrow()
        value, at = _lists(some.column("shingles")) if some.num_rows else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        names = list(zip(some.column("region").to_pylist(), some.column("class").to_pylist(), strict=True))
        table: dict[int, list[tuple[int, np.ndarray]]] = {}
        for j, (region, kind) in enumerate(names):
            table.setdefault(region, []).append((kind, value[at[j] : at[j + 1]]))
        shared = spark.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                value, at = _lists(batch.column("shingles"))
                region, kind = batch.column("region").to_numpy(), batch.column("class").to_numpy()
                size, rows = np.diff(at), []
                for r in np.unique(region):
                    mine = np.flatnonzero(region == r)
                    places = _ranges(at[mine], size[mine])
                    owner = np.repeat(np.arange(len(mine)), size[mine])
                    for pivot, wanted in shared.value.get(int(r), ()):
                        # Sets are sorted: membership is a search in the pivot's.
                        found = np.minimum(np.searchsorted(wanted, value[places]), len(wanted) - 1)
                        common = np.bincount(owner[wanted[found] == value[places]], minlength=len(mine))
                        union = size[mine] + len(wanted) - common
                        near = common > 0
                        columns = (kind[mine], np.full(len(mine), pivot), 1 - common / union, 100 * common >= percent * union)
                        rows.append((np.full(int(near.sum()), r), *(c[near] for c in columns)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if len(c) else [], k) for c, k in zip(columns, kinds, strict=True)],
                    names=["region", "class", "pivot", "distance", "linked"],
                )

        schema = "region bigint, class bigint, pivot bigint, distance double, linked boolean"
        found = map_batches(regions.select("region", "class", "shingles"), run, schema)
        found.write.mode("append" if i else "overwrite").parquet(path)
    return spark.read.parquet(path)


def join_large(regions: DataFrame, percent: int, limits: Limits, path: str) -> list[DataFrame]:
    """Links of regions that do not fit a task: rounds of pivots, then what is left in pairs of parts."""
    spark, links, radius = regions.sparkSession, [], 1 - percent / 100
    for step in range(limits.rounds):
        folder = f"{path}/{step}"
        state = regions.groupBy("region").agg(F.mode("grp", deterministic=True).alias("top"))
        # Pivots come from documents that are not in their region's largest group.
        others = regions.join(state, "region").where("grp <> top")
        draw = F.xxhash64("class", F.lit(step))
        n = others.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min(draw).alias("lowest"))
        share = F.lit(limits.pivots * 2**step) / F.col("n")
        is_pivot = (draw == F.col("lowest")) | ((draw / float(1 << 63) + 1) / 2 < share)
        pivots = written(spark, others.join(n, "region").where(is_pivot).select("region", "class", "shingles"), f"{folder}/pivots")
        near = _pivot_distances(regions, pivots, percent, limits, f"{folder}/distances")
        links.append(near.where("linked").select(F.col("class").alias("a"), F.col("pivot").alias("b")))
        # All pairs of a pivot are settled.
        left = regions.join(pivots.select("region", "class"), ["region", "class"], "left_anti")
        left = written(spark, _regroup(left, links[-1]), f"{folder}/left")
        closest = near.groupBy("region", "class").agg(F.min("distance").alias("closest"))
        placed = left.select("region", "class").join(closest, ["region", "class"], "left")
        placed = placed.withColumn("closest", F.coalesce("closest", F.lit(1.0)))
        reach = F.col("closest") + 2 * radius + 1e-9
        # Who is far from all pivots may be close to documents of any cell.
        everywhere = placed.where(reach >= 1).join(pivots.select("region", F.col("class").alias("pivot")), "region")
        somewhere = placed.where(reach < 1).join(near, ["region", "class"]).where(F.col("distance") <= reach)
        cells = everywhere.select("region", "class", "pivot").unionByName(somewhere.select("region", "class", "pivot"))
        size = cells.groupBy("region", "pivot").count().groupBy("region").agg(F.sum(F.col("count") * F.col("count")).alias("pairs"))
        before = left.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
        divided = before.join(size, "region").where("pairs <= 0.7 * n * n").select("region")
        divided = written(spark, divided, f"{folder}/divided")
        in_cells = (
            cells.join(divided, "region", "left_semi")
            .join(left, ["region", "class"])
            .select(F.xxhash64("region", "pivot").alias("region"), "class", "grp", "shingles")
        )
        regions = written(spark, left.join(divided, "region", "left_anti").unionByName(in_cells), f"{folder}/regions")
        small, regions, some = _by_size(regions, limits, f"{folder}/sizes")
        links.append(written(spark, join_regions(small, percent), f"{folder}/links"))
        if not some:
            return links
        regions = written(spark, regions, f"{folder}/large")
    # Parts of half a task's size, every two of a region together.
    parts = regions.groupBy("region").agg(
        F.ceil(F.greatest(F.sum(F.size("shingles")) * 2 / limits.hashes, F.count(F.lit(1)) * 2 / limits.classes)).alias("parts")
    )
    part = F.pmod(F.xxhash64("class"), F.col("parts"))
    in_pairs = regions.join(parts, "region").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = F.xxhash64("region", F.least("part", "other"), F.greatest("part", "other"))
    paired = in_pairs.select(pair.alias("region"), "class", "grp", "shingles")
    links.append(written(spark, join_regions(paired, percent), f"{path}/pairs"))
    return links


def similar_groups(
    documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE, limits: Limits | None = None
) -> DataFrame:
    """Every row of ``documents`` with the group of documents that it is connected with.

    Returned: doc_id, n_shingles, component_id, and class and group, which tell sets
    and groups of sets apart (null without shingles). Two documents are linked if
    100 * common >= percent * all of their shingles; component_id is the smallest
    doc_id that links lead to, itself included. Null texts and texts without
    words have no shingle and no link. Rows with equal sets are linked with each
    other; rows with one doc_id keep a row each, and connect what they are
    linked with. Null doc_ids link like others and are the smallest of a group
    only if it has no other. An empty table has an empty result.
    """
    limits = limits or Limits()
    spark = documents.sparkSession
    scratch = new_scratch(spark, "jaccard")
    # Of equal texts one is hashed and counted; copies would make shingles common that no other set has.
    digest = (F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y"))
    digests = written(spark, documents.select("doc_id", *digest), f"{scratch}/digests")
    ids = digests.groupBy("x", "y").agg(F.min("doc_id").alias("id")).select("id").where("id is not null").distinct()
    once = _wanted(ids, "id")
    order = shingle_order(documents, width, f"{scratch}/counts", once)
    digested = documents.select("doc_id", "text", *digest)
    sets = written(spark, first_shingles(digested, order, percent, width, ("x", "y"), once), f"{scratch}/sets")
    rows = written(spark, _with_classes(digests, sets), f"{scratch}/rows")
    # A shingle that is among the first of two different sets: they may be similar.
    first = sets.select("class", F.explode("first").alias("shingle"))
    shared = first.groupBy("shingle").agg(F.min("class").alias("pivot"), F.max("class").alias("last"))
    shared = written(spark, shared.where("pivot < last").select("shingle", "pivot"), f"{scratch}/shared")
    members = written(spark, first.distinct().join(shared, "shingle"), f"{scratch}/members")
    blocks = connected_components(members.select(F.col("class").alias("a"), F.col("pivot").alias("b")))
    sizes = sets.where("class is not null").groupBy("class").agg(F.first("n_shingles").alias("n_shingles"))
    blocks = blocks.select(F.col("node").alias("class"), F.col("component").alias("region")).join(sizes, "class")
    blocks = blocks.select("region", "class", F.col("class").alias("grp"), "n_shingles")
    blocks = written(spark, blocks, f"{scratch}/blocks")
    small, large, some = _by_size(blocks, limits, f"{scratch}/sizes")
    # Sets are moved once, to the task that joins them.
    small = _with_sets(documents, rows, written(spark, small, f"{scratch}/small"), width, limits)
    links = [written(spark, join_regions(small, percent), f"{scratch}/links")]
    if some:
        # Too much hangs together by chains: back to the shingles, once for each set of classes that share one.
        large = written(spark, large, f"{scratch}/large")
        inside = members.join(large.select("class").distinct(), "class", "left_semi").select("shingle", "class")
        alike = inside.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("class")).alias("x"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"),
        )
        one = alike.groupBy("n", "x", "y").agg(F.min("shingle").alias("shingle"))
        wide = inside.join(one.select("shingle"), "shingle", "left_semi").withColumnRenamed("shingle", "region")
        large = _with_sets(documents, rows, large, width, limits).dropDuplicates(["class"])
        wide = wide.join(large.select("class", "grp", "shingles"), "class").select("region", "class", "grp", "shingles")
        wide = written(spark, wide, f"{scratch}/wide")
        small, large, some = _by_size(wide, limits, f"{scratch}/wide-sizes")
        links.append(written(spark, join_regions(small, percent), f"{scratch}/wide-links"))
        if some:
            large = written(spark, _regroup(large, links[-1]), f"{scratch}/wide-large")
            links += join_large(large, percent, limits, f"{scratch}/rounds")
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    joined = connected_components(every)
    classes = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    classes = classes.join(joined.withColumnRenamed("node", "class"), "class", "left")
    classes = classes.withColumn("component", F.coalesce("component", "class"))
    classes = written(spark, classes, f"{scratch}/classes")
    groups = classes.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_classes"))
    groups = written(spark, groups, f"{scratch}/groups")
    of_class = attach(classes, groups, ["component"], "n_classes", classes.count())
    of_class = of_class.select("class", "component_id", F.col("component").alias("group"), "n")
    of_class = written(spark, of_class, f"{scratch}/of-class")
    rows = rows.select("doc_id", "n_shingles", "class")
    found = attach(rows.where("class is not null"), of_class, ["class"], "n", rows.count())
    alone = rows.where("class is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "class", F.lit(None).cast("bigint").alias("group")
    )
    return found.select("doc_id", "n_shingles", "component_id", "class", "group").unionByName(alone)


def one_of_each(documents: DataFrame, percent: int = PERCENT, width: int = SHINGLE, limits: Limits | None = None) -> DataFrame:
    """The rows of ``documents``, all columns, that are first in their group of similar ones.

    The document with the smallest doc_id stays, one row of it; documents without
    shingles all stay. Texts stay where they are unless their doc_id may be one
    that goes, or occurs more than once. Of those rows, the ones whose doc_id may
    also be one that stays are shuffled, so copies are not.
    """
    spark = documents.sparkSession
    found = similar_groups(documents, percent, width, limits).select("doc_id", "component_id", "class", "group")
    found = written(spark, found, new_scratch(spark, "groups"))
    same_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    goes = found.where(~same_id).select("doc_id")
    often = found.where("class is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    looked_at = goes.unionByName(often).where("doc_id is not null")
    stays = documents.where(~_may_be_in(looked_at, "doc_id")(F.col("doc_id")))
    ids = found.where(same_id).select("doc_id").where("doc_id is not null")
    # Columns of the documents may be called like those of the sets.
    own = [c if c == "text" else f"_own_{i}" for i, c in enumerate(documents.columns)]
    of_id = own[documents.columns.index("doc_id")]
    may_go, may_stay = _wanted(looked_at, "doc_id", of_id), _wanted(ids, "doc_id", of_id)
    asked = set_classes(documents.toDF(*own), width, own, lambda batch: pc.and_(may_go(batch), may_stay(batch)))
    classed = asked.toDF(*documents.columns, _MAY_GO)
    first = (
        found.where(same_id)
        .select(F.col("doc_id").alias("_id"), F.col("class").alias("_class"), F.col("group").alias("_group"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col(_MAY_GO).eqNullSafe(F.col("_class"))
    kept = classed.join(first, same)
    # Rows of one doc_id in one group: one stays.
    once = kept.where("_group is not null").dropDuplicates(["_id", "_group"]).unionByName(kept.where("_group is null"))
    return stays.unionByName(once.select(*documents.columns))


def _with_classes(digests: DataFrame, sets: DataFrame) -> DataFrame:
    """doc_id, n_shingles and class of every row of ``digests``."""
    of_text = sets.groupBy("x", "y").agg(F.first("n_shingles").alias("n_shingles"), F.first("class").alias("class"))
    often = digests.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    of_text = of_text.join(often, ["x", "y"])
    return attach(digests, of_text, ["x", "y"], "n", digests.count()).select("doc_id", "n_shingles", "class")


def _with_sets(documents: DataFrame, rows: DataFrame, blocks: DataFrame, width: int, limits: Limits) -> DataFrame:
    """region, class, grp and shingles of each class of ``blocks`` (a row each), at least once.

    Only texts of one document of each class are hashed again. Of few classes, the
    regions are known where texts are hashed, and sets are not moved to find them.
    """
    ids = rows.join(blocks, "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("id")).where("id is not null")
    texts, once = documents.select("doc_id", "text"), _wanted(ids, "id")
    if blocks.count() > limits.known:
        sets = shingle_sets(texts, width, where=once).where("class is not null").select("class", "shingles")
        sets = sets.join(blocks.select("class"), "class", "left_semi").dropDuplicates(["class"])
        return sets.join(blocks.select("region", "class", "grp"), "class").select("region", "class", "grp", "shingles")
    found = blocks.select("class", "region", "grp").toArrow().sort_by("class")
    known = documents.sparkSession.sparkContext.broadcast([found.column(c).to_numpy() for c in ("class", "region", "grp")])

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        value, at = hashed_sets(Texts.of(batch.column("text")), width)
        classes, region, grp = known.value
        kind = _classes(value, at)
        wanted = pc.fill_null(kind, 0).to_numpy()
        place = np.minimum(np.searchsorted(classes, wanted), max(0, len(classes) - 1))
        absent = classes[place] != wanted if len(classes) else np.ones(len(wanted), bool)
        absent |= kind.is_null().to_numpy(zero_copy_only=False)
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value))
        of_place = [pa.array(c[place], pa.int64(), mask=absent) if len(c) else pa.nulls(len(wanted), pa.int64()) for c in (region, grp)]
        return [of_place[0], kind, of_place[1], lists]

    schema = "region bigint, class bigint, grp bigint, shingles array<bigint>"
    sets = map_texts(texts, work, schema, most=SLICE_BYTES, where=once)
    return sets.where("region is not null").drop("doc_id")


def _wanted(ids: DataFrame, column: str, name: str = "doc_id") -> Callable[[pa.RecordBatch], pa.Array]:
    """Which rows of a batch have an id of the table, null, or one of a few others in column ``name``.

    Asked where texts are worked on anyway, this takes no further Python worker.
    """
    shared = ids.sparkSession.sparkContext.broadcast(KeyFilter.of(ids, column))
    return lambda batch: _held(shared.value, batch.column(name))


def _held(ids: KeyFilter, keys: pa.Array) -> pa.Array:
    # Ids stay what they are: no detour by way of floating point.
    known = pc.fill_null(keys.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return pc.or_(pa.array(ids.may_hold(known), pa.bool_()), keys.is_null())


def _may_be_in(ids: DataFrame, column: str):
    """A function of a column that is true for all ids of the table, for null, and for a few others."""
    spark = ids.sparkSession
    send_package(spark)
    shared = spark.sparkContext.broadcast(KeyFilter.of(ids, column))

    @F.arrow_udf("boolean")
    def may_be_in(keys: pa.Array) -> pa.Array:
        return _held(shared.value, keys)

    return may_be_in
