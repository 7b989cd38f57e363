"""Whole texts of an Arrow batch as one byte buffer, and their words as arrays.

All rules of this package are about bytes: lower-casing touches A-Z only, and
both kinds of words are runs of bytes of a class. UTF-8 never uses ASCII bytes
inside a character, so runs of bytes are runs of characters.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_BYTE = np.arange(256)
_UPPER = (_BYTE >= ord("A")) & (_BYTE <= ord("Z"))
LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
_SPACE = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
_ALNUM = (
    ((_BYTE >= ord("0")) & (_BYTE <= ord("9")))
    | ((_BYTE >= ord("a")) & (_BYTE <= ord("z")))
    | (_BYTE >= 0x80)
)
#: Words of the class [^\x20\x09-\x0D] and, on lower-cased text, [^\x00-\x2F\x3A-\x60\x7B-\x7F].
SPACED, ALPHANUMERIC = ~_SPACE, _ALNUM

#: Bytes of text that are worked on at once; a longer text is worked on alone.
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Words:
    """The words of some texts: byte ranges in ``data``; text i has words ``at[i]:at[i+1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    at: np.ndarray

    @cached_property
    def _encoded(self) -> tuple[np.ndarray, pa.Array]:
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int32), pa.array([], pa.binary())
        bounds = np.empty(2 * n, np.int64)
        bounds[0::2], bounds[1::2] = self.starts, self.ends
        # Words and the gaps between them alternate; the gaps' codes are left out.
        pieces = pa.Array.from_buffers(
            pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(bounds), pa.py_buffer(self.data)]
        ).dictionary_encode()
        codes = pieces.indices.to_numpy()[0::2]
        used = np.zeros(len(pieces.dictionary), bool)
        used[codes] = True
        renumbered = (np.cumsum(used) - 1).astype(np.int32)
        return renumbered[codes], pieces.dictionary.filter(pa.array(used))

    @property
    def codes(self) -> np.ndarray:
        """For each word, its place in ``distinct``."""
        return self._encoded[0]

    @property
    def distinct(self) -> list[bytes]:
        return self._encoded[1].to_pylist()

    @property
    def distinct_array(self) -> pa.Array:
        return self._encoded[1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        one = xxhash.xxh3_64_intdigest
        return np.fromiter((one(w) for w in self.distinct), np.uint64, len(self.distinct_array))[self.codes]

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.counts)


@dataclass(frozen=True)
class Texts:
    """Texts side by side in ``data``; text i is ``data[at[i]:at[i+1]]``, null as empty."""

    data: np.ndarray
    at: np.ndarray
    lowered: bool = field(default=False)

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = column.buffers()
        n = len(column)
        if not n:
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return cls(whole[at[0] : at[-1]], at - at[0])

    def __len__(self) -> int:
        return len(self.at) - 1

    def lower(self) -> Texts:
        return Texts(LOWER[self.data], self.at, True)

    def one(self, i: int) -> bytes:
        return self.data[self.at[i] : self.at[i + 1]].tobytes()

    def words(self, kind: np.ndarray) -> Words:
        inside = kind[self.data]
        n = len(inside)
        begins, ends = np.empty(n, bool), np.empty(n, bool)
        if n:
            begins[0], begins[1:] = True, ~inside[:-1]
            ends[-1], ends[:-1] = True, ~inside[1:]
            # Texts touch in the buffer: words end where their text does.
            begins[self.at[:-1][self.at[:-1] < n]] = True
            ends[self.at[1:][self.at[1:] > 0] - 1] = True
            begins &= inside
            ends &= inside
        starts = np.flatnonzero(begins)
        return Words(self.data, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, self.at))


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values[at[i]:at[i+1]]`` for each i; values may have a second axis."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def pieces(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of text, or of one row."""
    column = batch.column(batch.schema.get_field_index("text"))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, on executors that need not have this package installed."""
    send_package(df.sparkSession)

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(run_and_release, schema)


def release_memory() -> None:
    """Give freed memory back: Spark uses a Python worker for one task after another."""
    from orderloom.llm import words_bpe

    words_bpe.forget()
    pa.default_memory_pool().release_unused()
    # The C library keeps what was freed, too; others than glibc have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_SENT: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of an application, once."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    _SENT.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    if not package.is_dir():
        return  # it runs from an archive, which Spark has already sent
    # Spark itself takes the archive from the driver to the executors.
    archive = Path(tempfile.mkdtemp(prefix="orderloom-code-")) / "orderloom_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


def map_texts(
    documents: DataFrame,
    work: Callable[[pa.RecordBatch], list[pa.Array]],
    schema: str,
    keep: Sequence[str] = ("doc_id",),
    read: Sequence[str] = (),
    most: int = BATCH_BYTES,
    where: Callable[[pa.RecordBatch], pa.Array] | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``documents`` and those of ``schema``, one row per row.

    ``work`` gets batches with ``text`` and the columns ``keep`` and ``read``, at
    most ``most`` bytes of text at once, and returns the arrays of ``schema``.
    ``where`` tells the rows that are wanted, if not all are.
    Other columns of ``documents`` are not read, whatever they are called.
    """
    keep = list(keep)
    source = documents.select(*dict.fromkeys([*keep, *read, "text"]))
    added = StructType.fromDDL(schema)
    result = StructType([source.schema[c] for c in keep] + added.fields)
    wanted = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch if where is None else batch.filter(where(batch))
            for piece in pieces(batch, most):
                kept = [piece.column(c) for c in keep]
                arrays = [
                    a if a.type == f.type else a.cast(f.type)
                    for a, f in zip([*kept, *work(piece)], wanted, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=wanted.names)

    return map_batches(source, run, result)


def remainder(key: str, divisor: int):
    """crc32 of a column as text, modulo ``divisor``; null for null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor
