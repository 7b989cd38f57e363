"""Hard negatives by lists that a cluster of anchors shares.

Anchors that point the same way form a cluster. For each cluster all rows are
ordered once by a bound on their inner product with any member: a row of norm n at
angle t to the centre has at most ``n * cos(t - radius)`` times the member's norm.
Every member walks that list from the top, and stops when the bound of what is
left is below the last score it needs: then its result is certified, whatever the
rows are. First the walk finds the nearest rows of the same label; their scores
give the windows in which the second walk looks for rows of other labels.

The list of a cluster is cut into segments by the bound, which come in strides, so
that members whose result is certified cost no more. A segment has no size of its
own: its rows come in blocks, from all over the table, each met by the members in
groups of bounded size, and top lists of blocks are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import map_batches, send_package
from orderloom.scratch import new_scratch, written

c = F.col

#: Anchors per cluster, clusters at most, and members that meet a block at once.
PER_CLUSTER, MOST_CLUSTERS, GROUP = 256, 512, 256
#: Rows at most that centres and the cuts between segments are chosen from; every row is in the lists.
SAMPLE_ROWS = 20_000
#: Segments of a list, and the strides in which they are walked.
SEGMENTS, STRIDES = 64, ((0, 4), (4, 16), (16, 64))
_STEP = 512  # rows scored before a member's floor is raised
_SLACK = 1e-6  # radians, far above rounding errors of angles

_BLOCK = "cluster int, salt int, row binary, id binary, id_null binary, label binary, vector binary, bound binary"
_GROUP = "cluster int, part int, row binary, label binary, vector binary, norm binary, floor binary, low binary, high binary"
_FOUND = "row bigint, slot int, id bigint, score bigint"


@dataclass(frozen=True)
class Wanted:
    """How many positives, how many negatives for each, and their window in percent of the positive's score."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95


def quantized(embeddings: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, label and vector of the rows that can take part, components as whole numbers.

    Rows without label or vector, or with a component that is null or not finite,
    are left out.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    usable = c("label").isNotNull() & c(vector).isNotNull() & ~bad
    return embeddings.where(usable).select(c("vec_id").cast("bigint"), c("label").cast("bigint"), whole.alias("vector"))


def hard_negatives(rows: DataFrame, is_anchor: Column, wanted: Wanted | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label, vector (whole numbers), as ``quantized`` gives them;
    other columns are not read. A row's score is its inner product with the
    anchor; higher scores come first, of equal ones the smaller vec_id, null last.
    An anchor's positives are its first other rows of the same label; to each
    belong the first rows of other labels whose score is in the window. Shorter
    vectors count as filled up with zeros. Rows that are repeated count as often
    as they are there, and a repeated anchor has its results as often. A positive
    without a row in its window gives no row, as does an anchor without positives
    or an empty table. Scores beyond 64 bits are given as the largest number.
    """
    spark = rows.sparkSession
    send_package(spark)
    wanted = wanted or Wanted()
    scratch = new_scratch(spark, "hard-negatives")
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vector", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    numbered = written(spark, numbered, f"{scratch}/rows")
    lists = _Lists.of(numbered, f"{scratch}/members")
    if lists is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")

    near = lists.walk(f"{scratch}/positives", None, wanted.positives, wanted)
    positives = near.select("row", c("nth").alias("slot"), c("id").alias("positive_id"), c("score").alias("positive_score"))
    far = lists.walk(f"{scratch}/negatives", positives, wanted.negatives, wanted)
    return (
        far.select("row", "slot", c("nth").alias("rank"), c("id").alias("negative_id"), c("score").alias("negative_score"))
        .join(positives, ["row", "slot"])
        .join(lists.members.select("row", c("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of a batch as rows, filled up with zeros."""
    n = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if len(n) and (n == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(n), width), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)] = values
    return out


def _norms(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(1))


def _angles(matrix: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles of rows to centres of length one; a row of zeros is at a right angle."""
    cosine = matrix.astype(np.float64) @ centres.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _centres(matrix: np.ndarray, k: int) -> np.ndarray:
    """Directions of ``k`` clusters, by a few rounds of means on the sphere."""
    norms = _norms(matrix)
    unit = matrix / np.where(norms > 0, norms, 1.0)[:, None]
    centres = unit[np.random.default_rng(7).choice(len(unit), k, replace=False)]
    for _ in range(8):
        nearest = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, unit)
        length = np.sqrt((sums**2).sum(1))
        centres = np.where(length[:, None] > 0, sums / np.where(length > 0, length, 1.0)[:, None], centres)
    return centres


@dataclass(frozen=True)
class _Lists:
    """The shared lists: centres and radii of clusters, and bounds between segments."""

    rows: DataFrame
    members: DataFrame
    width: int
    kind: str  # of vectors in blocks
    exact_floats: bool
    centres: np.ndarray
    radius: np.ndarray
    cuts: np.ndarray  # per cluster, lower bounds of its segments

    @classmethod
    def of(cls, rows: DataFrame, path: str) -> _Lists | None:
        spark = rows.sparkSession
        # The size of the most negative whole number is not one itself; as a double it is.
        largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
        known = rows.agg(
            F.max(F.size("vector")).alias("width"),
            F.coalesce(F.max(largest), F.lit(0.0)).alias("largest"),
            F.count_if("is_anchor").alias("anchors"),
        ).first()
        if not known["anchors"]:
            return None
        width = max(1, known["width"])

        def sample(of: DataFrame) -> np.ndarray:
            found = of.select("row", "vector").orderBy(F.xxhash64("row"), "row").limit(SAMPLE_ROWS).toArrow()
            return _matrix(found.column("vector").combine_chunks(), width).astype(np.float64)

        anchors = rows.where("is_anchor")
        k = min(MOST_CLUSTERS, -(-known["anchors"] // PER_CLUSTER), SAMPLE_ROWS)
        centres = _centres(sample(anchors), k)

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _matrix(batch.column("vector"), width)
                angles = _angles(vectors, _norms(vectors), centres)
                cluster = angles.argmin(1)
                more = [pa.array(cluster.astype(np.int32)), pa.array(angles[np.arange(len(cluster)), cluster])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "cluster", "angle"])

        schema = "row bigint, vec_id bigint, label bigint, vector array<bigint>, cluster int, angle double"
        members = written(spark, map_batches(anchors.drop("is_anchor"), assigned, schema), path)
        radius, sizes = np.zeros(k), np.zeros(k, np.int64)
        # One row per cluster.
        for found in members.groupBy("cluster").agg(F.max("angle").alias("angle"), F.count(F.lit(1)).alias("n")).collect():
            radius[found["cluster"]], sizes[found["cluster"]] = found["angle"], found["n"]
        parts = F.element_at(F.lit((-(-sizes // GROUP)).tolist()), c("cluster") + 1)
        members = members.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int"))

        some = sample(rows)
        bounds = _bounds(some, centres, radius)
        cuts = np.quantile(bounds, 1 - np.arange(1, SEGMENTS) / SEGMENTS, axis=0).T
        top = known["largest"]
        kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
        return cls(rows, members, width, kind, top * top * width < 1 << 53, centres, radius, cuts)

    def walk(self, path: str, positives: DataFrame | None, k: int, wanted: Wanted) -> DataFrame:
        """row, slot, nth, id, score: the first ``k`` rows for each slot of each member.

        Without ``positives`` there is one slot, of rows with the member's label;
        with them each is a slot, of rows with other labels in its window.
        """
        spark = self.rows.sparkSession
        found = spark.createDataFrame([], _FOUND)
        order = Window.partitionBy("row", "slot").orderBy(c("score").desc(), c("id").asc_nulls_last())
        for i, (begin, end) in enumerate(STRIDES):
            groups = written(spark, self._groups(found, positives, k, wanted, begin), f"{path}/groups-{i}")
            # At most one number per cluster.
            active = sorted(r["cluster"] for r in groups.select("cluster").distinct().collect())
            if not active:
                break
            more = self._scored(groups, active, begin, end, k, positives is not None)
            best = found.unionByName(more).withColumn("nth", F.row_number().over(order)).where(c("nth") <= k)
            best = written(spark, best, f"{path}/found-{i}")
            found = best.select("row", "slot", "id", "score")
        return found.withColumn("nth", F.row_number().over(order))

    def _groups(self, found: DataFrame, positives: DataFrame | None, k: int, wanted: Wanted, begin: int) -> DataFrame:
        """Members whose result is not certified yet, packed; ``floor`` is the last score of each full slot."""
        width, kind, cuts = self.width, self.kind, self.cuts
        full = found.groupBy("row", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last")).where(c("n") >= k)
        floors = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "last"))).alias("floors"))
        members = self.members.join(floors, "row", "left")
        if positives is None:
            slots = 1
            members = members.withColumn("scores", F.lit(None).cast("map<int, bigint>"))
        else:
            slots = wanted.positives
            scores = F.map_from_entries(F.collect_list(F.struct("slot", "positive_score"))).alias("scores")
            members = members.join(positives.groupBy("row").agg(scores), "row")
        members = members.select("cluster", "part", "row", "label", "vector", "floors", "scores")

        def packed(table: pa.Table) -> pa.Table:
            cluster = table.column("cluster")[0].as_py()
            vectors = _matrix(table.column("vector").combine_chunks(), width)
            norms = _norms(vectors)
            n, least = len(norms), np.iinfo(np.int64).min
            floor, low, high = np.full((n, slots), least), np.full((n, slots), least), np.full((n, slots), np.iinfo(np.int64).max)
            for i, (known, scores) in enumerate(zip(table.column("floors").to_pylist(), table.column("scores").to_pylist(), strict=True)):
                for slot, last in known or ():
                    floor[i, slot - 1] = last
                if scores is not None:
                    low[i], high[i] = 1, 0  # a slot without a positive takes nothing
                    for slot, score in scores:
                        low[i, slot - 1] = -(-wanted.low * score // 100)
                        high[i, slot - 1] = wanted.high * score // 100
            # What is left of the list cannot reach this.
            rest = cuts[cluster, begin - 1] * norms if begin else np.full(n, np.inf)
            needed = np.where(low > high, np.iinfo(np.int64).max, np.maximum(floor, low)).min(1)
            open_ = rest >= needed
            if not open_.any():
                return table_of([], [])
            row = [cluster, table.column("part")[0].as_py()]
            arrays = [
                table.column("row").to_numpy()[open_].astype("<i8"),
                table.column("label").to_numpy()[open_].astype("<i8"),
                vectors[open_].astype(kind),
                norms[open_],
                *(x[open_].astype("<i8") for x in (floor, low, high)),
            ]
            return table_of(row, [a.tobytes() for a in arrays])

        def table_of(numbers: list, arrays: list) -> pa.Table:
            names = [f.split()[0] for f in _GROUP.split(", ")]
            kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 7
            values = [*numbers, *arrays] or [None] * 9
            return pa.table([pa.array([v] if numbers else [], t) for v, t in zip(values, kinds, strict=True)], names=names)

        return members.groupBy("cluster", "part").applyInArrow(packed, _GROUP)

    def _scored(self, groups: DataFrame, active: list[int], begin: int, end: int, k: int, windows: bool) -> DataFrame:
        """The best rows of every block of the stride for every group of members."""
        width, kind, exact = self.width, self.kind, self.exact_floats
        centres, radius, cuts = self.centres[active], self.radius[active], self.cuts[active]
        tasks = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = -(-2 * tasks // len(active))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            salt = TaskContext.get().partitionId()
            for batch in batches:
                vectors = _matrix(batch.column("vector"), width)
                bounds = _bounds(vectors, centres, radius)
                ids = batch.column("vec_id")
                columns = [
                    batch.column("row").to_numpy().astype("<i8"),
                    ids.fill_null(0).to_numpy().astype("<i8"),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    batch.column("label").to_numpy().astype("<i8"),
                    vectors.astype(kind),
                ]
                out = []
                for j, cluster in enumerate(active):
                    bound = bounds[:, j]
                    # Cuts descend; a row on a cut is above it.
                    segment = np.searchsorted(-cuts[j], -bound, side="left")
                    chosen = np.flatnonzero((segment >= begin) & (segment < end))
                    chosen = chosen[np.argsort(-bound[chosen], kind="stable")]
                    if len(chosen):
                        out.append((cluster, salt % salts, *(x[chosen].tobytes() for x in columns), bound[chosen].tobytes()))
                    salt += 1
                if out:
                    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 6
                    names = [f.split()[0] for f in _BLOCK.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        block = map_batches(self.rows.select("row", "vec_id", "label", "vector"), blocks, _BLOCK)
        block = block.toDF("cluster", "salt", *(f"block_{x}" for x in block.columns[2:]))
        spread = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield _best_of_block(row, width, kind, exact, k, windows)

        return map_batches(block.join(spread, ["cluster", "salt"]), best, _FOUND)


def _bounds(vectors: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per row and cluster, the most a member of norm one can score with the row."""
    norms = _norms(vectors)
    angles = _angles(vectors, norms, centres)
    return norms[:, None] * np.cos(np.maximum(0.0, angles - radius - _SLACK)) * (1 + 1e-9) + 1e-9


def _best_of_block(row: dict, width: int, kind: str, exact: bool, k: int, windows: bool) -> pa.RecordBatch:
    """Each member walks the block, whose rows are in order of their bounds."""

    def array(name: str, dtype: str) -> np.ndarray:
        return np.frombuffer(row[name], dtype)

    as_number = np.float64 if exact else object
    members = array("vector", kind).reshape(-1, width).astype(as_number)
    rows = array("block_vector", kind).reshape(-1, width).astype(as_number)
    member_row, member_label, norm = array("row", "<i8"), array("label", "<i8"), array("norm", "<f8")
    floor, low, high = (array(n, "<i8").reshape(len(norm), -1).copy() for n in ("floor", "low", "high"))
    row_, id_, no_id = array("block_row", "<i8"), array("block_id", "<i8"), array("block_id_null", "?")
    label, bound = array("block_label", "<i8"), array("block_bound", "<f8")
    floor = np.where(low > high, np.iinfo(np.int64).max, np.maximum(floor, low))
    found: list[tuple[np.ndarray, ...]] = []
    walking = np.arange(len(norm))
    for a in range(0, len(row_), _STEP):
        # Certified: what follows has no larger bound.
        walking = walking[bound[a] * norm[walking] >= floor[walking].min(1)]
        if not len(walking):
            break
        part = slice(a, a + _STEP)
        scores = members[walking] @ rows[part].T
        limit = np.iinfo(np.int64).max
        scores = scores.astype(np.int64) if exact else np.clip(scores, -limit, limit).astype(np.int64)
        same = member_label[walking][:, None] == label[part]
        fits = ~same if windows else same & (member_row[walking][:, None] != row_[part])
        for slot in range(floor.shape[1]):
            least = floor[walking, slot]
            eligible = fits & (scores >= least[:, None]) & (scores <= high[walking, slot][:, None])
            who, what = np.nonzero(eligible)
            if not len(who):
                continue
            found.append((walking[who], np.full(len(who), slot), what + a, scores[who, what]))
            if eligible.shape[1] >= k:
                kth = -np.partition(-np.where(eligible, scores, np.iinfo(np.int64).min + 1), k - 1, axis=1)[:, k - 1]
                floor[walking, slot] = np.maximum(least, kth)
    if not found:
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], names=["row", "slot", "id", "score"])
    who, slot, what, score = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((id_[what], no_id[what], -score, slot, who))
    who, slot, what, score = who[order], slot[order], what[order], score[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (slot[1:] != slot[:-1])
    begin = np.flatnonzero(new)
    first = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who)))) < k
    who, slot, what, score = who[first], slot[first], what[first], score[first]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(member_row[who]),
            pa.array((slot + 1).astype(np.int32)),
            pa.array(id_[what], mask=no_id[what]),
            pa.array(score),
        ],
        names=["row", "slot", "id", "score"],
    )
