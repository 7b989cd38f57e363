"""Token ids in directly addressable codes: any token is read without decoding a block.

An id is cut into chunks of 8 bits, lowest first. Level k holds the k-th chunk of
every id that has one, in order, and a bitmap that tells for each whether the id
goes on in level k + 1. A rank directory counts the set bits before every 512th,
so the place of an id in the next level is one look-up and a few bytes' bit
count. A file row is one segment: whole documents with consecutive ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.batches import Texts, map_batches, pieces
from orderloom.llm.words_bpe import encode
from orderloom.scratch import new_scratch

#: Fixed values of the file format.
_MAGIC, _RANK_BITS = b"DAC1", 512

#: Ids of a segment; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 20
_SEGMENT = "part int, nth int, n_docs bigint, n_ids bigint, doc_ids binary, ends binary, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """The bytes of a sequence of ids below 2 ** 32."""
    levels = []
    rest = np.asarray(ids, np.uint32)
    while True:
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little").tobytes()
        padded = np.zeros(-(-max(len(rest), 1) // _RANK_BITS) * _RANK_BITS, bool)
        padded[: len(rest)] = goes_on
        before = padded.reshape(-1, _RANK_BITS).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(before, dtype=np.uint32) - before).astype("<u4").tobytes()
        chunks = rest.astype(np.uint8).tobytes()
        levels.append(np.array([len(rest)], "<u4").tobytes() + chunks + bits + ranks)
        rest = rest[goes_on] >> np.uint32(8)
        if not len(rest):
            return _MAGIC + bytes([len(levels)]) + b"".join(levels)


class Packed:
    """Reader of what ``pack`` wrote."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a sequence of token codes")
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = 5
        for _ in range(data[4]):
            n = int(np.frombuffer(data, "<u4", 1, place)[0])
            n_bits, n_ranks = -(-n // 8), -(-max(n, 1) // _RANK_BITS)
            chunks = np.frombuffer(data, np.uint8, n, place + 4)
            bits = np.frombuffer(data, np.uint8, n_bits, place + 4 + n)
            ranks = np.frombuffer(data, "<u4", n_ranks, place + 4 + n + n_bits)
            self.levels.append((chunks, bits, ranks))
            place += 4 + n + n_bits + 4 * n_ranks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """The i-th id, from one chunk and one rank per level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // _RANK_BITS
            whole = bits[block * _RANK_BITS // 8 : i >> 3]
            partial = int(bits[i >> 3]) & ((1 << (i & 7)) - 1)
            i = int(ranks[block]) + int(np.bitwise_count(whole).sum()) + partial.bit_count()
            shift += 8
        return value

    def all(self) -> np.ndarray:
        """All ids in order."""
        value = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            higher, value = value, chunks.astype(np.uint32)
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            value[goes_on] |= higher << np.uint32(8)
        return value


def write_codes(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all documents, each with ``end_id`` at its end, in ascending doc_id order.

    Documents are dealt by ranges of doc_id, as texts: they are encoded after
    that, once, and their ids never move. Null or empty text has the end id
    only; a null doc_id comes first; rows with one doc_id follow each other in
    order of their text. An empty table writes a table without rows.
    """
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = documents.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def segment() -> pa.RecordBatch:
            docs, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [part, nth, len(docs), len(ids), docs.astype("<i8").tobytes(), np.cumsum(counts).astype("<i8").tobytes(), pack(ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                names=["part", "nth", "n_docs", "n_ids", "doc_ids", "ends", "codes"],
            )

        for batch in batches:
            for piece in pieces(batch):
                texts = Texts.of(piece.column("text"))
                docs = piece.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                ids, at = encode(texts, tokenizer)
                ids, at = np.insert(ids, at[1:], end_id).astype(np.uint32), at + np.arange(len(at))
                a = 0
                while a < len(docs):
                    # As many whole documents as fit, one at least.
                    b = max(a + 1, int(np.searchsorted(at, at[a] + SEGMENT_IDS - size, side="right")) - 1)
                    b = min(b, len(docs))
                    if size and size + at[b] - at[a] > SEGMENT_IDS:
                        yield segment()
                        held, size, nth = [], 0, nth + 1
                        continue
                    held.append((docs[a:b], np.diff(at[a : b + 1]), ids[at[a] : at[b]]))
                    size += int(at[b] - at[a])
                    a = b
        if held:
            yield segment()

    map_batches(ordered, run, _SEGMENT).write.mode("overwrite").parquet(path)


_NO_ID = -(1 << 63)


def read_codes(spark, path: str) -> DataFrame:
    """What the files hold, per document: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids before the document in the whole collection:
    the segments before its own are summed from their headers.
    """
    segments = spark.read.parquet(path)
    # One row per written partition is ordered here, then a partition's segments within it.
    of_part = segments.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_part = of_part.select("part", F.coalesce(F.sum("part_ids").over(earlier), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        segments.select("part", "nth", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside"))
        .join(of_part, "part")
        .select("part", "nth", (F.col("before_part") + F.col("inside")).alias("segment_start"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nth, docs, ends, codes in zip(
                *(batch.column(c).to_pylist() for c in ("part", "nth", "doc_ids", "ends", "codes")), strict=True
            ):
                ids = Packed(codes).all().astype("<u4")
                stop = np.frombuffer(ends, "<i8")
                start = np.concatenate([[0], stop[:-1]])
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                doc = np.frombuffer(docs, "<i8")
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.full(n, nth, np.int32)),
                        pa.array(doc, mask=doc == _NO_ID),
                        pa.array(start.astype(np.int64)),
                        pa.array((stop - start).astype(np.int64)),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "nth", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    schema = "part int, nth int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
    # A few numbers per written partition and segment; Spark broadcasts them if they are small.
    found = map_batches(segments.select("part", "nth", "doc_ids", "ends", "codes"), run, schema)
    return found.join(starts, ["part", "nth"]).select(
        "doc_id", (F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_table(documents: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write ``documents`` as token codes and return what the files hold."""
    spark = documents.sparkSession
    path = path or new_scratch(spark, "token-codes")
    write_codes(documents, path, tokenizer, end_id)
    return read_codes(spark, path)
