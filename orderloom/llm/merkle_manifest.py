"""A Merkle manifest of a table of documents, with an inclusion proof for every row.

Every document is a leaf. The leaves of a language, ordered by doc_id, make a
tree of eight-way nodes; the roots of the languages make one more tree above.

Leaves get a rank by a range sort. The base-8 digits of a rank say where its leaf
stands: 8 ** BLOCK_LEVELS consecutive leaves are a block, and within a block the
digits are grouped away one after another, the lowest first, each time nesting
the children as structs below their node. A block is one row of bounded size, all
of its groupings run on one shuffle, and unfolding it again hands every leaf the
hashes beside its path: proofs need no join of leaves. The blocks are the leaves
of the next tier, which is built in the same way, so no task holds more than a
block, whatever the size of a language.

Everything here is built-in functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.spread import SMALL_ROWS, attach
from orderloom.scratch import new_scratch, written

c = F.col

#: Children of a node, and the columns of a leaf in their order.
FAN_BITS = 3
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

#: Levels that one block of nested structs spans: 4 make 4,096 leaves.
BLOCK_LEVELS = 4

_PATH = "array<struct<left: string, right: string>>"
_NTH_BITS = 33  # of monotonically_increasing_id: rows within a partition


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(values: Mapping[str, Column] | None = None) -> Column:
    """Hash of a document: each column as its byte count and value, ``-`` for null.

    ``values`` replaces columns by other expressions.
    """
    parts = []
    for name in LEAF_COLUMNS:
        text = (values or {}).get(name, c(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return digest(F.concat(*parts))


def manifest(documents: DataFrame, carry: Mapping[str, Column] | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root and path of every row, and the columns ``carry``.

    ``path`` lists, from the leaf up to the root, what stands left and right of
    the path's node among the children of its parent, as concatenated hex
    digests: hashing ``left || node || right`` again and again gives the root
    (``fold``). ``carry`` are expressions over ``documents``, computed where the
    texts are read. Columns beyond LEAF_COLUMNS are not read, whatever their names.

    Order: nulls come before all else, in lang as in doc_id; rows with one doc_id
    go by their leaf, and full copies are all the same. An empty or long text is
    hashed like any other. A language of one document has the leaf as its root, a
    table of one language that language's root. An empty table has no rows.
    """
    spark = documents.sparkSession
    scratch = new_scratch(spark, "manifest")
    carry = dict(carry or {})
    hashed = documents.select(
        # Null is less than every language, and bytewise order stays.
        F.coalesce(F.concat(F.lit("="), c("lang")), F.lit("")).alias("tree"),
        F.struct("doc_id", leaf_hash().alias("leaf"), *(e.alias(n) for n, e in carry.items())).alias("own"),
    )
    leaves = written(spark, hashed.withColumn("node", c("own.leaf")), f"{scratch}/leaves")
    ranked = _ranked(spark, leaves, [c("own.doc_id").asc_nulls_first(), c("node")], f"{scratch}/ranked")

    subtrees = _Tree(spark, ranked, f"{scratch}/languages", block_levels)
    roots = subtrees.roots().select(F.lit("").alias("tree"), c("tree").alias("own"), c("top").alias("node"))
    roots = written(spark, roots, f"{scratch}/roots")
    above = _Tree(spark, _ranked(spark, roots, [c("own")], f"{scratch}/ranked-roots"), f"{scratch}/root", block_levels)
    outer = above.paths().select(c("own").alias("tree"), c("path").alias("outer"), c("top").alias("root"))
    outer = written(spark, outer, f"{scratch}/outer")

    return subtrees.paths(outer).select(
        "own.doc_id", "own.leaf", c("top").alias("subroot"), "root", "path", *(f"own.{n}" for n in carry)
    )


def fold(node: Column, path: str = "path") -> Column:
    """The root that ``node`` leads to along ``path``."""
    return F.aggregate(path, node, lambda below, beside: digest(F.concat(beside["left"], below, beside["right"])))


def proof_digest(path: str = "path") -> Column:
    """One hash over all siblings of a path, leaf to root, left to right."""
    return digest(F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), ""))


def _ranked(spark: SparkSession, nodes: DataFrame, order: Sequence[Column], path: str) -> DataFrame:
    """tree, own, node, rank (from 0 within the tree) and levels (of the tree).

    A range sort over (tree, order): a tree of any size is spread over many
    tasks. Positions are a partition's rows plus those of the partitions before
    it, of which there are as many numbers as partitions.
    """
    keys = [c("tree"), *order, c("copy")]
    # Full copies have any order; numbering them lets the sort spread them, too.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = nodes.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
    placed = ordered.sortWithinPartitions(*keys).drop("copy").withColumn("place", F.monotonically_increasing_id())
    rows = written(spark, placed, path).withColumns(
        {"part": F.shiftright("place", _NTH_BITS), "nth": c("place").bitwiseAND(F.lit((1 << _NTH_BITS) - 1))}
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    parts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    # One number per written partition.
    at = rows.join(F.broadcast(parts), "part").withColumn("at", c("before") + c("nth")).select("tree", "own", "node", "at")
    trees = written(spark, at.groupBy("tree").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size")), f"{path}-trees")
    # The height is the number of base-8 digits of the last rank.
    last_bits = F.length(F.bin(c("size") - 1))
    return _with_trees(at, trees).select(
        "tree",
        "own",
        "node",
        (c("at") - c("first")).alias("rank"),
        F.when(c("size") == 1, 0).otherwise(F.ceil(last_bits / FAN_BITS)).cast("int").alias("levels"),
    )


def _with_trees(rows: DataFrame, trees: DataFrame) -> DataFrame:
    """Join a table with a row per tree, which says ``size`` of each."""
    if trees.count() <= SMALL_ROWS:
        return rows.join(F.broadcast(trees), "tree")
    total = trees.agg(F.sum("size")).first()[0]
    return attach(rows, trees, ["tree"], "size", total)


class _Tree:
    """The trees of ranked nodes, in tiers of blocks."""

    def __init__(self, spark: SparkSession, ranked: DataFrame, scratch: str, block_levels: int, base: int = 0):
        self.spark, self.scratch, self.block_levels, self.base = spark, scratch, block_levels, base
        self.blocks = written(spark, self._rolled_up(ranked), f"{scratch}/tier-{base}")
        highest = self.blocks.agg(F.max("levels")).first()[0] or 0
        self.higher = None
        if highest > base + block_levels:
            nodes = self.blocks.select("tree", c("block").alias("own"), c("block").alias("rank"), "node", "levels")
            self.higher = _Tree(spark, nodes, scratch, block_levels, base + block_levels)

    def _rolled_up(self, ranked: DataFrame) -> DataFrame:
        """One row per block: its node, and ``kids``, its tree as nested structs."""
        digits = [f"digit_{k}" for k in range(self.block_levels)]
        split = {d: F.shiftright("rank", FAN_BITS * k).bitwiseAND(F.lit((1 << FAN_BITS) - 1)) for k, d in enumerate(digits)}
        block = F.shiftright("rank", FAN_BITS * self.block_levels)
        nodes = ranked.withColumns(split | {"block": block}).withColumnRenamed("own", "kids")
        nodes = nodes.select("tree", "levels", "block", *digits, "node", "kids").repartition("tree", "block")
        for k, digit in enumerate(digits):
            # Rows of a block are together; grouping by more columns moves nothing.
            children = F.sort_array(F.collect_list(F.struct(digit, "node", "kids")))
            nodes = nodes.groupBy("tree", "levels", "block", *digits[k + 1 :]).agg(children.alias("kids"))
            joined = digest(F.array_join(F.transform("kids", lambda kid: kid["node"]), ""))
            # Above a tree's own height there is nothing to hash: its one node stays.
            whole = F.when(c("levels") > self.base + k, joined).otherwise(c("kids")[0]["node"])
            nodes = nodes.withColumn("node", whole)
        return nodes

    def roots(self) -> DataFrame:
        """tree, top: the root of each tree."""
        if self.higher is not None:
            return self.higher.roots()
        return self.blocks.select("tree", c("node").alias("top"))

    def paths(self, outer: DataFrame | None = None) -> DataFrame:
        """tree, top, own and path of every node, and the columns of ``outer``.

        ``outer`` has a row per tree, with the path ``outer`` that goes on above it.
        """
        if self.higher is None:
            at_root = F.array().cast(_PATH).alias("path")
            blocks = self.blocks.select("tree", "levels", "kids", c("node").alias("top"), at_root)
        else:
            # One row per block on either side.
            upper = self.higher.paths().select("tree", c("own").alias("block"), "path", "top")
            blocks = self.blocks.drop("node").join(upper, ["tree", "block"]).drop("block")
        more = []
        if outer is not None:
            more = [name for name in outer.columns if name not in ("tree", "outer")]
            sizes = blocks.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
            blocks = _with_trees(blocks, outer.join(sizes, "tree")).drop("size")
            blocks = blocks.withColumn("path", F.concat("path", "outer")).drop("outer")
        for k in reversed(range(self.block_levels)):
            blocks = self._unfolded(blocks, k, more)
        return blocks.select("tree", "top", c("kids").alias("own"), "path", *more)

    def _unfolded(self, nodes: DataFrame, k: int, more: Sequence[str]) -> DataFrame:
        """A row per child, with the hashes beside it in front of its parent's path."""

        def hashes(kids: Column) -> Column:
            return F.array_join(F.transform(kids, lambda kid: kid["node"]), "")

        def placed(kid: Column, i: Column) -> Column:
            left, right = F.slice("kids", F.lit(1), i), F.slice("kids", i + 2, F.lit(1 << FAN_BITS))
            return F.struct(kid["kids"].alias("kids"), hashes(left).alias("left"), hashes(right).alias("right"))

        kid = nodes.select("tree", "levels", "top", "path", *more, F.explode(F.transform("kids", placed)).alias("kid"))
        beside = F.array(F.struct("kid.left", "kid.right"))
        path = F.when(c("levels") > self.base + k, F.concat(beside, "path")).otherwise(c("path"))
        return kid.select("tree", "levels", "top", path.alias("path"), *more, c("kid.kids").alias("kids"))
