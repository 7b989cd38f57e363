"""Exact duplicates by content-defined chunk recipes.

Texts are cut where their own bytes say so, equal chunks get one verified
identifier, and texts are equal if their ordered lists of identifiers are. Each
different chunk is moved once per task that holds it; long documents themselves
are never moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import Texts, map_texts
from orderloom.llm.spread import attach
from orderloom.scratch import new_scratch, written

#: A cut follows a byte whose window hash has these bits clear: 2 KB per chunk on average.
_CUT_MASK = np.uint32(0x7FF00000)
#: Bytes that decide a cut, and the longest chunk.
_WINDOW_STEPS, MAX_CHUNK = 5, 32 << 10
#: Recipes of more chunks than this are compared in shuffles only, never broadcast.
_SHORT_RECIPE = 1000

_MIX = (np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def cuts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of each text, and how many chunks each text has.

    The hash of the last 32 bytes is made by doubling: two windows of w bytes
    give one of 2 w. An empty text has no chunk.
    """
    rolled = _MIX[data]
    width, factor = 1, np.uint32(0x01000193)
    for _ in range(_WINDOW_STEPS):
        wider = rolled.copy()
        if len(data) > width:
            wider[width:] += rolled[:-width] * factor
        rolled, width, factor = wider, width * 2, np.uint32((int(factor) * int(factor)) & 0xFFFFFFFF)
    is_end = (rolled & _CUT_MASK) == 0
    # A window that reaches into the text before tells nothing about this one.
    sizes = np.diff(at)
    for i in np.flatnonzero(sizes > 0):
        is_end[at[i] : min(at[i] + width - 1, at[i + 1])] = False
    is_end[at[1:][sizes > 0] - 1] = True
    ends = np.flatnonzero(is_end) + 1
    starts = np.concatenate([[0], ends[:-1]])
    long_ = np.flatnonzero(ends - starts > MAX_CHUNK)
    if len(long_):
        more = [np.arange(starts[i] + MAX_CHUNK, ends[i], MAX_CHUNK) for i in long_]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends, np.diff(np.searchsorted(ends, at, side="right"))


def _fingerprint(chunk: bytes, bits: int) -> int:
    return (xxhash.xxh3_64_intdigest(chunk) & ((1 << bits) - 1)) - (1 << bits - 1)


def _chunks(batch: pa.RecordBatch) -> tuple[Texts, list[bytes], np.ndarray]:
    texts = Texts.of(batch.column("text")).lower()
    ends, n = cuts(texts.data, texts.at)
    whole, starts = memoryview(np.ascontiguousarray(texts.data)), np.concatenate([[0], ends[:-1]]).astype(int)
    return texts, [bytes(whole[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], n


def _lists(values, n: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), values)


def recipes(documents: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, text_sha256 and the fingerprints of the text's chunks, in order."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, found, n = _chunks(batch)
        prints = np.fromiter((_fingerprint(c, bits) for c in found), np.int64, len(found))
        sha = [hashlib.sha256(texts.data[a:b]).hexdigest() for a, b in zip(texts.at[:-1], texts.at[1:], strict=True)]
        return [pa.array(sha, pa.string()), _lists(pa.array(prints), n)]

    return map_texts(documents, work, "text_sha256 string, prints array<bigint>")


def chunk_contents(documents: DataFrame, bits: int = 64) -> DataFrame:
    """A row per chunk: doc_id, text_sha256 of its text, place, fingerprint and content."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, found, n = _chunks(batch)
        rows = [(p, c) for p, c in zip((_fingerprint(c, bits) for c in found), found, strict=True)]
        items = pa.array([{"print": p, "chunk": c} for p, c in rows], pa.struct([("print", pa.int64()), ("chunk", pa.binary())]))
        sha = [hashlib.sha256(texts.data[a:b]).hexdigest() for a, b in zip(texts.at[:-1], texts.at[1:], strict=True)]
        return [pa.array(sha, pa.string()), _lists(items, n)]

    found = map_texts(documents, work, "text_sha256 string, chunks array<struct<print: bigint, chunk: binary>>")
    return found.select("doc_id", "text_sha256", F.posexplode("chunks").alias("place", "c")).select(
        "doc_id", "text_sha256", "place", "c.print", "c.chunk"
    )


def exact_groups(documents: DataFrame, bits: int = 64) -> DataFrame:
    """Every row of ``documents`` with the document that stays for its text.

    Texts are compared after lower-casing A-Z; null counts as empty, and empty
    texts are equal. Of a group the row with the largest doc_id stays (rows that
    share that doc_id stay together; a null doc_id is smaller than any other).
    Returned: doc_id, keep_id, group_size, kept, text_sha256, chunks (number).
    An empty table has an empty result. ``bits`` is the width of fingerprints:
    whatever it is, chunks with one fingerprint and different content get
    different identifiers.
    """
    spark = documents.sparkSession
    scratch = new_scratch(spark, "chunks")
    found = written(spark, recipes(documents, bits), f"{scratch}/recipes")
    contents = chunk_contents(documents, bits)
    # Verification: each content under a fingerprint is moved once per task, and compared whole.
    shared = written(
        spark,
        contents.groupBy("print", "chunk")
        .agg(F.lit(1).alias("one"))
        .groupBy("print")
        .agg(F.count("one").alias("variants"))
        .where("variants > 1"),
        f"{scratch}/shared-prints",
    )
    identified = found.withColumn("ids", F.transform("prints", lambda p: F.struct(p.alias("print"), F.lit(0).alias("variant"))))
    if not shared.isEmpty():
        identified = _with_variants(found, contents, shared)
        identified = written(spark, identified, f"{scratch}/identified")
    counted = identified.groupBy("ids").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = written(spark, counted.where("group_size > 1"), f"{scratch}/groups")
    joined = attach(
        identified, groups, ["ids"], "group_size", found.count(), how="left", may_broadcast=F.size("ids") <= _SHORT_RECIPE
    )
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
        F.size("ids").alias("chunks"),
    )


def _with_variants(found: DataFrame, contents: DataFrame, shared: DataFrame) -> DataFrame:
    """The recipes with numbers for the contents that share a fingerprint; others are number 0."""
    ambiguous = contents.join(shared.select("print"), "print", "left_semi")
    numbers = (
        ambiguous.select("print", "chunk")
        .distinct()
        .withColumn("variant", F.row_number().over(Window.partitionBy("print").orderBy("chunk")) - 1)
    )
    # Rows with one doc_id and one text have one recipe.
    of_row = (
        ambiguous.join(numbers, ["print", "chunk"])
        .groupBy("doc_id", "text_sha256")
        .agg(F.map_from_entries(F.collect_set(F.struct("place", "variant"))).alias("variants"))
        .select(F.col("doc_id").alias("row_id"), F.col("text_sha256").alias("row_sha"), "variants")
    )
    same = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("text_sha256") == F.col("row_sha"))
    number = lambda place: F.coalesce(F.col("variants")[place], F.lit(0))
    return found.join(of_row, same, "left").select(
        "doc_id",
        "text_sha256",
        F.transform("prints", lambda p, place: F.struct(p.alias("print"), number(place).alias("variant"))).alias("ids"),
    )
