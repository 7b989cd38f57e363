"""Passages that an earlier document has, found by sorting suffixes at a difference cover.

Every byte covered by a string of LENGTH bytes that also starts in a document of
smaller doc_id goes. Positions are sampled by a difference cover: residues modulo
a period of which, for any two positions, one offset below the period leads both
to samples. Two equal strings therefore share a sampled suffix, and at least its
first ``triple`` bytes (three words of ten bytes for a length of 50).

1. Sampled triples are named and the names counted over the whole corpus. A
   suffix whose triple occurs in one document only is final and goes no further.
   As only LENGTH bytes of a suffix matter, a triple is all that two strings must
   share: the recursion on names ends here, it need not number the names again.
2. Of the stretches around suffixes that are left, equal ones are found whole:
   cut where their content says so, hashed, and kept with their first document.
3. The other suffixes are merged with the sampled ones: what is left goes, with
   the bytes before and after the sample, to the task of its name. There suffixes
   are sorted, adjacent ones compared byte by byte, and for each number of bytes
   before the sample the runs of equal strings get their first document.

Texts stay in one table, bucketed by slices of a few megabytes that no later step
shuffles again. A step sends a request per slice and range of names, and the
answer comes back to the slice as bits in the order of the request. Within a slice
equal things are requested once, so a passage that a third of all documents hold
costs a row per slice; names in very many slices are compared string by string
instead of suffix by suffix, each string in a task of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.batches import Texts, map_batches, pieces, send_package
from orderloom.scratch import new_scratch, written

#: Bytes of a string that counts as repeated.
LENGTH = 50
#: Bytes of text in a slice; a longer text is a slice of its own.
SLICE_BYTES = 8 << 20
#: Names found in more slices than this are compared string by string.
HOT_SLICES = 128

# Perfect difference sets by their period.
_COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 6, 8, 18),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
}
_NO_ID = -(1 << 63)
_PIECE_BITS = 6  # 64 strings per content-defined piece on average
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_U32 = np.uint64(32)

_REQUEST = "slice bigint, r int, kind int, n int, keys binary, docs binary"
_ANSWER = "slice bigint, r int, kind int, bits binary"
_STRETCHES = "slice bigint, docs binary, nth binary, starts binary, sizes binary, text binary, samples binary, hot binary, names binary"
_REMOVED = "slice bigint, nth binary, starts binary, ends binary"
_TRIPLES, _PIECES, _SUFFIXES, _STRINGS = range(4)


@dataclass(frozen=True)
class Cover:
    """Sampled positions: those whose remainder by ``period`` is in ``residues``."""

    length: int
    period: int
    residues: tuple[int, ...]

    @classmethod
    def of(cls, length: int) -> Cover:
        """The widest cover that leaves more than half of ``length`` to compare."""
        if not 6 <= length <= 255:
            raise ValueError("strings have 6 to 255 bytes")
        period = max(p for p in _COVERS if 2 * p <= length)
        return cls(length, period, _COVERS[period])

    @property
    def triple(self) -> int:
        return self.length - self.period + 1

    @property
    def before(self) -> int:
        """The most bytes of a string that lie before its sample."""
        return self.period - 1

    def samples(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions of texts side by side, in order, and their texts."""
        sizes = np.diff(at)
        n = np.where(sizes >= self.length, (sizes - self.triple) // self.period + 1, 0)
        text = np.repeat(np.arange(len(n)), n)
        place = (at[:-1][text] + self.period * _counting(n))[:, None] + np.array(self.residues)
        fits = place <= (at[1:] - self.triple)[text][:, None]
        return place[fits], np.repeat(text, fits.sum(1))


def _counting(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, and so on."""
    total = np.cumsum(n)
    return np.arange(total[-1] if len(n) else 0) - np.repeat(total - n, n)


class _Words:
    """Eight bytes at any place of a buffer at once."""

    def __init__(self, data: np.ndarray, beyond: int):
        padded = np.zeros((len(data) + beyond + 23) // 8 * 8, np.uint8)
        padded[: len(data)] = data
        self.aligned = padded.view("<u8")

    def at(self, place: np.ndarray, n_bytes: int) -> Iterator[np.ndarray]:
        """The ``n_bytes`` at each place as words, the last one padded with zeros."""
        word, shift = place >> 3, ((place & 7) << 3).astype(np.uint64)
        back = np.uint64(63) - shift
        low = self.aligned[word]
        for k in range(0, n_bytes, 8):
            word = word + 1
            high = self.aligned[word]
            both = (low >> shift) | ((high << back) << np.uint64(1))
            if n_bytes - k < 8:
                both &= np.uint64((1 << 8 * (n_bytes - k)) - 1)
            yield both
            low = high

    def hashes(self, place: np.ndarray, n_bytes: int) -> np.ndarray:
        return _mixed(self.at(place, n_bytes))


def _mixed(words: Iterable[np.ndarray]) -> np.ndarray:
    """One 64-bit hash of several words."""
    h = _B
    for word in words:
        h = (h ^ word) * _A
        h ^= h >> np.uint64(29)
    h = h * _B
    return h ^ (h >> _U32)


def _planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second: high bytes compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplaned(data: bytes, n: int, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel()


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before; the first always."""
    new = np.ones(len(columns[0]), bool)
    for i, column in enumerate(columns):
        differs = column[1:] != column[:-1]
        new[1:] = differs if i == 0 else new[1:] | differs
    return new


@dataclass(frozen=True)
class _Entries:
    """Different things of a slice, in the order of their request, with their first documents."""

    #: For each thing of the slice, its entry; and for each entry one thing, its range and its first document.
    of_thing: np.ndarray
    thing: np.ndarray
    range_: np.ndarray
    first: np.ndarray
    #: More than one document of the slice has it.
    shared: np.ndarray

    @classmethod
    def of(cls, range_: np.ndarray, columns: list[np.ndarray], docs: np.ndarray) -> _Entries:
        """Things are equal if all ``columns`` are; ranges ascend, and in them a single column does."""
        if not len(range_):
            nothing = np.zeros(0, np.int64)
            return cls(nothing, nothing, nothing, nothing, nothing.astype(bool))
        mixed = columns[0] if len(columns) == 1 else _mixed(columns) >> _U32
        key = (range_ << _U32) | mixed
        order = np.argsort(key)
        new = _starts(key[order])
        if len(columns) > 1:
            # Different things with one key are told apart by all columns.
            same = np.flatnonzero(~new)
            if any((c[order[same]] != c[order[same - 1]]).any() for c in columns):
                order = np.lexsort((*reversed(columns), key))
                new = _starts(key[order], *(c[order] for c in columns))
        begin = np.flatnonzero(new)
        of_thing = np.empty(len(order), np.int64)
        of_thing[order] = np.cumsum(new) - 1
        ordered, thing = docs[order], order[begin]
        first = np.minimum.reduceat(ordered, begin)
        return cls(of_thing, thing, range_[thing], first, np.maximum.reduceat(ordered, begin) != first)

    def requests(self, slice_: int, kind: int, keys) -> Iterator[tuple]:
        """A row per range; ``keys`` gives the bytes of entries a to b."""
        if not len(self.range_):
            return
        bounds = np.flatnonzero(_starts(self.range_))
        for a, b in zip(bounds, np.append(bounds[1:], len(self.range_)), strict=True):
            yield slice_, int(self.range_[a]), kind, int(b - a), *keys(a, b)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _answers(table: pa.Table, kind: int) -> list[bytes]:
    """Answers of one kind, in the order of their ranges."""
    found = sorted(
        (r, bits)
        for r, k, bits in zip(*(table.column(c).to_pylist() for c in ("r", "kind", "bits")), strict=True)
        if k == kind
    )
    return [bits for _, bits in found]


class _Slice:
    """Texts of a slice, in order, and their documents."""

    def __init__(self, table: pa.Table, cover: Cover, ranges: int):
        rows = table.sort_by("nth").combine_chunks()
        self.rows, self.cover = rows, cover
        texts = Texts.of(rows.column("text").combine_chunks())
        self.data, self.at = texts.data, texts.at
        self.docs = rows.column("doc").to_numpy()
        self.place, owner = cover.samples(self.at)
        self.owner = owner
        names = _Words(self.data, cover.length).hashes(self.place, cover.triple)
        self.entries = _Entries.of(((names >> _U32) * np.uint64(ranges)) >> _U32, [names & np.uint64(0xFFFFFFFF)], self.docs[owner])
        self.names = names

    def requests(self, slice_: int) -> Iterator[tuple]:
        names = (self.names[self.entries.thing] & np.uint64(0xFFFFFFFF)).astype("<u4")

        def keys(a: int, b: int) -> tuple[bytes, bytes]:
            # Names of a range ascend; their differences are small.
            return _planes(np.diff(names[a:b], prepend=np.uint32(0)).astype("<u4")), np.packbits(self.entries.shared[a:b]).tobytes()

        return self.entries.requests(slice_, _TRIPLES, keys)

    def stretches(self, slice_: int, answers: pa.Table) -> list[tuple]:
        """What lies around samples whose names other documents have, too."""
        bits = np.concatenate([np.frombuffer(b, np.uint8) for b in _answers(answers, _TRIPLES)] or [np.zeros(0, np.uint8)])
        found = bits[self.entries.of_thing] if len(bits) else np.zeros(0, np.uint8)
        left = np.flatnonzero(found)
        if not len(left):
            return []
        place, owner = self.place[left], self.owner[left]
        # Strings of the text that hold the sample's triple.
        low = np.maximum(place - self.cover.before, self.at[owner])
        high = np.minimum(place, self.at[owner + 1] - self.cover.length) + 1
        n = len(self.data) + 1
        inside = np.cumsum(np.bincount(low, minlength=n) - np.bincount(high, minlength=n)) > 0
        edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        begin, end = edges[0::2], edges[1::2]
        sizes = end - begin + self.cover.length - 1
        text = np.searchsorted(self.at, begin, side="right") - 1
        whole = np.repeat(begin, sizes) + _counting(sizes)
        offset = np.cumsum(sizes) - sizes
        run = np.searchsorted(begin, place, side="right") - 1
        samples = place - begin[run] + offset[run]
        return [
            (
                slice_,
                self.docs[text].astype("<i8").tobytes(),
                text.astype("<i4").tobytes(),
                (begin - self.at[text]).astype("<i8").tobytes(),
                sizes.astype("<i4").tobytes(),
                _packed(self.data[whole].tobytes()),
                _packed(_planes(np.diff(samples, prepend=0).astype("<u4"))),
                np.packbits(found[left] > 1).tobytes(),
                _planes((self.names[left] >> _U32).astype("<u4")),
            )
        ]


class _Stretches:
    """Stretches of a slice, side by side in ``data``; a string is named by where it starts."""

    def __init__(self, table: pa.Table, cover: Cover, ranges: int):
        (row,) = table.to_pylist()
        self.slice, self.cover, self.ranges = row["slice"], cover, np.uint64(ranges)
        self.docs, self.nth = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["nth"], "<i4")
        self.starts, self.sizes = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["sizes"], "<i4").astype(np.int64)
        self.data = np.frombuffer(_unpacked(row["text"]), np.uint8)
        steps = _unpacked(row["samples"])
        n = len(steps) // 4
        self.samples = np.cumsum(_unplaned(steps, n, "<u4").astype(np.int64))
        self.hot = np.unpackbits(np.frombuffer(row["hot"], np.uint8), count=n).astype(bool)
        self.names = _unplaned(row["names"], n, "<u4").astype(np.uint64)
        self.offset = np.cumsum(self.sizes) - self.sizes
        self.strings = self.sizes - cover.length + 1
        self.words = _Words(self.data, cover.length + 8)
        self._cut()

    def _cut(self) -> None:
        """Pieces: strings between places whose next bytes say so; each string is in one."""
        run = np.repeat(np.arange(len(self.strings)), self.strings)
        nth = _counting(self.strings)
        place = self.offset[run] + nth
        begins = (self.words.hashes(place, min(8, self.cover.length)) >> np.uint64(64 - _PIECE_BITS)) == 0
        first = np.flatnonzero(begins | (nth == 0))
        self.piece, self.piece_run = place[first], run[first]
        self.piece_strings = np.diff(np.append(first, len(place)))
        whole, size = memoryview(self.data), self.cover.length - 1
        prints = b"".join(
            hashlib.blake2b(whole[a : a + n + size], digest_size=16).digest()
            for a, n in zip(self.piece.tolist(), self.piece_strings.tolist(), strict=True)
        )
        high, low = np.frombuffer(prints, "<u8").reshape(-1, 2).T
        self.piece_keys = high, low
        self.pieces = _Entries.of(((high >> _U32) * self.ranges) >> _U32, [high, low], self.docs[self.piece_run])

    def piece_requests(self) -> Iterator[tuple]:
        high, low = (k[self.pieces.thing] for k in self.piece_keys)

        def keys(a: int, b: int) -> tuple[bytes, bytes]:
            return high[a:b].tobytes() + low[a:b].tobytes(), _planes(self.pieces.first[a:b].astype("<i8"))

        return self.pieces.requests(self.slice, _PIECES, keys)

    def _covered_by(self, entries: _Entries, docs: np.ndarray, answers: list[bytes]) -> np.ndarray:
        """Things of which a smaller document has an equal one."""
        elsewhere = np.concatenate([np.frombuffer(b, np.uint8) for b in answers] or [np.zeros(0, np.uint8)]).astype(bool)
        return elsewhere[entries.of_thing] | (docs > entries.first[entries.of_thing])

    def covered_pieces(self, answers: pa.Table) -> np.ndarray:
        """Per place, whether the string that starts there is known to be repeated."""
        known = self._covered_by(self.pieces, self.docs[self.piece_run], _answers(answers, _PIECES))
        covered = np.zeros(len(self.data), bool)
        n = self.piece_strings[known]
        covered[np.repeat(self.piece[known], n) + _counting(n)] = True
        return covered

    def _open(self, covered: np.ndarray) -> tuple[np.ndarray, ...]:
        """Samples around which a string is not covered yet: place, run, range of strings."""
        run = np.searchsorted(self.offset, self.samples, side="right") - 1
        low = np.maximum(self.samples - self.cover.before, self.offset[run])
        high = np.minimum(self.samples, self.offset[run] + self.strings[run] - 1)
        free = np.concatenate([[0], np.cumsum(~covered)])
        return run, low, high, free[high + 1] > free[low]

    def suffixes(self, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Entries, np.ndarray]:
        """Samples to compare, the bytes around them, and their entries.

        A row of bytes holds what is before the sample, backwards, what follows,
        and how many bytes of either there are.
        """
        run, _, _, is_open = self._open(covered)
        chosen = np.flatnonzero(is_open & ~self.hot)
        place, run = self.samples[chosen], run[chosen]
        n_left = np.minimum(place - self.offset[run], self.cover.before)
        n_right = np.minimum(self.offset[run] + self.sizes[run] - place, self.cover.length)
        before, length = self.cover.before, self.cover.length
        padded = np.concatenate([np.zeros(before, np.uint8), self.data, np.zeros(length, np.uint8)])
        width = -(-(before + length + 2) // 8) * 8
        rows = np.zeros((len(place), width), np.uint8)
        for k in range(before):
            rows[:, k] = np.where(k < n_left, padded[place + before - 1 - k], 0)
        for k in range(length):
            rows[:, before + k] = np.where(k < n_right, padded[place + before + k], 0)
        rows[:, before + length], rows[:, before + length + 1] = n_left, n_right
        range_ = (self.names[chosen] * self.ranges) >> _U32
        entries = _Entries.of(range_, list(rows.view("<u8").T), self.docs[run])
        return place, run, n_left, entries, rows

    def strings_of_hot(self, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Entries, np.ndarray]:
        """Strings around samples with very frequent names: place, run, entries, bytes."""
        run, low, high, is_open = self._open(covered)
        chosen = np.flatnonzero(is_open & self.hot)
        n = len(self.data) + 1
        inside = np.cumsum(np.bincount(low[chosen], minlength=n) - np.bincount(high[chosen] + 1, minlength=n)) > 0
        place = np.flatnonzero(inside[:-1] & ~covered)
        run = np.searchsorted(self.offset, place, side="right") - 1
        rows = np.stack(list(self.words.at(place, self.cover.length)), 1) if len(place) else np.zeros((0, -(-self.cover.length // 8)), "<u8")
        range_ = ((self.words.hashes(place, self.cover.length) >> _U32) * self.ranges) >> _U32
        return place, run, _Entries.of(range_, list(rows.T), self.docs[run]), rows.view(np.uint8)

    def suffix_requests(self, answers: pa.Table) -> Iterator[tuple]:
        covered = self.covered_pieces(answers)
        _, _, _, suffixes, suffix_rows = self.suffixes(covered)
        _, _, strings, string_rows = self.strings_of_hot(covered)
        for kind, entries, rows in ((_SUFFIXES, suffixes, suffix_rows), (_STRINGS, strings, string_rows)):

            def keys(a: int, b: int, entries=entries, rows=rows) -> tuple[bytes, bytes]:
                return _packed(rows[entries.thing[a:b]].tobytes()), _planes(entries.first[a:b].astype("<i8"))

            yield from entries.requests(self.slice, kind, keys)

    def removed(self, answers: pa.Table) -> list[tuple]:
        """Byte ranges that go, by the text's place in the slice."""
        pieces_ = self.covered_pieces(answers)
        covered = pieces_.copy()
        place, run, n_left, entries, _ = self.suffixes(pieces_)
        bits = b"".join(_answers(answers, _SUFFIXES))
        if bits:
            of_entry = np.frombuffer(bits, "<u8").reshape(-1, -(-self.cover.period // 64))
            later = self.docs[run] > entries.first[entries.of_thing]
            last = self.offset[run] + self.strings[run] - 1
            for k in range(self.cover.period):
                repeated = (of_entry[:, k >> 6][entries.of_thing] >> np.uint64(k & 63)) & np.uint64(1) == 1
                valid = (k <= n_left) & (place - k <= last)
                covered[(place - k)[(repeated | later) & valid]] = True
        place, run, entries, _ = self.strings_of_hot(pieces_)
        if len(place):
            covered[place[self._covered_by(entries, self.docs[run], _answers(answers, _STRINGS))]] = True
        edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
        begin, end = edges[0::2], edges[1::2]
        if not len(begin):
            return []
        run = np.searchsorted(self.offset, begin, side="right") - 1
        start = self.starts[run] + begin - self.offset[run]
        end = start + (end - begin) + self.cover.length - 1
        return [(self.slice, self.nth[run].astype("<i4").tobytes(), start.astype("<i8").tobytes(), end.astype("<i8").tobytes())]


def _resolved(table: pa.Table, cover: Cover, hot_slices: int) -> pa.Table:
    """Answers to all requests of one kind and range."""
    rows = table.select(["slice", "r", "kind", "n", "keys", "docs"]).to_pylist()
    kind, n = rows[0]["kind"], np.array([row["n"] for row in rows])
    if kind == _TRIPLES:
        answers = _repeated_names(rows, n, hot_slices)
    else:
        docs = np.concatenate([_unplaned(row["docs"], row["n"], "<i8") for row in rows])
        if kind == _PIECES:
            keys = [np.frombuffer(row["keys"], "<u8").reshape(2, -1) for row in rows]
            answers = _has_earlier(list(np.concatenate(keys, 1)), docs).astype(np.uint8)
        else:
            size = -(-cover.length // 8) if kind == _STRINGS else -(-(cover.before + cover.length + 2) // 8)
            keys = np.concatenate([np.frombuffer(_unpacked(row["keys"]), "<u8").reshape(-1, size) for row in rows])
            answers = _has_earlier(list(keys.T), docs).astype(np.uint8) if kind == _STRINGS else _repeated_around(keys.view(np.uint8), docs, cover)
    ends = np.cumsum(n)
    out = [(row["slice"], row["r"], kind, answers[b - k : b].tobytes()) for row, k, b in zip(rows, n.tolist(), ends.tolist(), strict=True)]
    return _table(out, _arrow(_ANSWER))


def _repeated_names(rows: list[dict], n: np.ndarray, hot_slices: int) -> np.ndarray:
    """0: one document only, 1: more, 2: very many slices."""
    names = np.concatenate([np.cumsum(_unplaned(row["keys"], row["n"], "<u4"), dtype=np.uint32) for row in rows])
    shared = np.concatenate([np.unpackbits(np.frombuffer(row["docs"], np.uint8), count=row["n"]) for row in rows])
    order = np.argsort(names)
    new = _starts(names[order])
    begin = np.flatnonzero(new)
    slices = np.diff(np.append(begin, len(order)))
    found = (slices > 1) | (np.maximum.reduceat(shared[order], begin) > 0)
    answers = np.empty(len(order), np.uint8)
    answers[order] = np.where(slices > hot_slices, 2, found.astype(np.uint8))[np.cumsum(new) - 1]
    return answers


def _has_earlier(columns: list[np.ndarray], docs: np.ndarray) -> np.ndarray:
    """Whether a row with equal columns has a smaller document."""
    order = np.lexsort((docs, *reversed(columns)))
    new = _starts(*(c[order] for c in columns))
    first = docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = first < docs[order]
    return earlier


def _sorted_side(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings, and how many first bytes each shares with the one before.

    ``n``: how many bytes of a row count; of rows that are equal the shorter is first.
    """
    # Byte strings of one length compare byte by byte, zeros included; the last byte is the number.
    whole = np.concatenate([rows, n.astype(np.uint8)[:, None]], 1)
    order = np.argsort(whole.view(f"S{whole.shape[1]}").ravel())
    shared = np.zeros(len(rows), np.int64)
    a, b = rows[order[1:]], rows[order[:-1]]
    differs = a != b
    common = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    shared[1:] = np.minimum(common, np.minimum(n[order[1:]], n[order[:-1]]))
    return order, shared


def _ordered(major: np.ndarray, minor: np.ndarray, bits: int) -> np.ndarray:
    """Order by two numbers and then by place, by sorting one number; all have at most ``bits`` bits."""
    joined = (((major << bits) | minor) << bits) | np.arange(len(major))
    return np.sort(joined) & ((1 << bits) - 1)


def _repeated_around(rows: np.ndarray, docs: np.ndarray, cover: Cover) -> np.ndarray:
    """For each suffix, a bit per number of bytes before it: a smaller document has that string.

    Suffixes are sorted once by what follows and once by what is before them.
    Those that share a string are neighbours in both orders: they have the same
    class of ``length - k`` bytes after and of ``k`` bytes before the sample.
    """
    before, length = cover.before, cover.length
    by_doc = np.argsort(docs, kind="stable")
    rows, docs_ = rows[by_doc], docs[by_doc]
    n_left, n_right = rows[:, before + length].astype(np.int64), rows[:, before + length + 1].astype(np.int64)
    right, right_shared = _sorted_side(rows[:, before : before + length], n_right)
    left, left_shared = _sorted_side(rows[:, :before], n_left)
    bits = np.zeros((len(rows), -(-cover.period // 64)), np.uint64)
    right_class, left_class = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    size = len(rows).bit_length()
    wide = 3 * size > 63
    for k in range(cover.period):
        right_class[right] = np.cumsum(right_shared < length - k)
        left_class[left] = np.cumsum(left_shared < k)
        valid = np.flatnonzero((n_left >= k) & (n_right >= length - k))
        if not len(valid):
            continue
        # Classes and then the row: rows are in order of their documents.
        order = np.lexsort((left_class[valid], right_class[valid])) if wide else _ordered(right_class[valid], left_class[valid], size)
        new = _starts(right_class[valid][order], left_class[valid][order])
        ordered = docs_[valid][order]
        earlier = ordered[np.flatnonzero(new)][np.cumsum(new) - 1] < ordered
        bits[valid[order[earlier]], k >> 6] |= np.uint64(1 << (k & 63))
    out = np.empty_like(bits)
    out[by_doc] = bits
    return out


def _sliced(documents: DataFrame, slice_bytes: int) -> DataFrame:
    """slice, nth, doc_id, doc and text: rows of a scan task in slices, as they come."""
    source = documents.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slice_, held, nth = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for piece in pieces(batch, slice_bytes // 4):
                size = piece.column("text").nbytes
                if held and held + size > slice_bytes:
                    slice_, held, nth = slice_ + 1, 0, 0
                held += size
                n = len(piece)
                places = pa.array(np.full(n, slice_, np.int64)), pa.array(np.arange(nth, nth + n, dtype=np.int32))
                nth += n
                yield pa.RecordBatch.from_arrays([*places, *piece.columns], names=["slice", "nth", *piece.schema.names])

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, run, f"slice bigint, nth int, doc_id {kind}, doc bigint, text string")


def _bucketed(spark: SparkSession, df: DataFrame, path: str, n: int) -> str:
    """Write ``df`` as a table with a bucket per part of its slices; its name."""
    name = f"orderloom_{uuid.uuid4().hex}"
    df.write.bucketBy(n, "slice").format("parquet").option("path", path).option("compression", "zstd").saveAsTable(name)
    return name


def repeated_passages(
    documents: DataFrame,
    length: int = LENGTH,
    slice_bytes: int = SLICE_BYTES,
    hot_slices: int = HOT_SLICES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept, one row per row.

    Texts are their UTF-8 bytes; ``kept`` is what is left of a text, as bytes (a
    cut may go through a character). A byte goes if a string of ``length`` bytes
    that covers it also starts in a document of smaller doc_id; strings are those
    of the input. A null doc_id is smaller than any other; rows with one doc_id
    are one document, which takes nothing from itself, also where it repeats. Null
    texts are empty, texts shorter than ``length`` lose nothing, and an empty
    table has no rows. Other columns are not read, whatever their names.

    Equal pieces are told by 128 bits of BLAKE2b; all other strings are compared
    byte by byte.
    """
    spark = documents.sparkSession
    send_package(spark)
    scratch = new_scratch(spark, "suffixes")
    cover, n = Cover.of(length), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _bucketed(spark, _sliced(documents, slice_bytes), f"{scratch}/texts", n)
    texts = spark.table(name)
    try:
        steps = _Steps(spark, cover, n, hot_slices, scratch)
        removed = steps.removed(texts)
        kind = documents.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
        return written(spark, steps.cut(texts, removed, schema), f"{scratch}/result")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


class _Steps:
    """The steps over all slices; each is written before the next reads it."""

    def __init__(self, spark: SparkSession, cover: Cover, ranges: int, hot_slices: int, scratch: str):
        self.spark, self.cover, self.ranges, self.hot_slices, self.scratch = spark, cover, ranges, hot_slices, scratch

    def _resolve(self, requests: DataFrame, step: str) -> DataFrame:
        cover, hot = self.cover, self.hot_slices
        answers = requests.groupBy("r", "kind").applyInArrow(lambda t: _resolved(t, cover, hot), _ANSWER)
        return written(self.spark, answers, f"{self.scratch}/{step}")

    def removed(self, texts: DataFrame) -> DataFrame:
        cover, ranges = self.cover, self.ranges
        request, stretches, removed = _arrow(_REQUEST), _arrow(_STRETCHES), _arrow(_REMOVED)

        def id_of(table: pa.Table) -> int:
            return table.column("slice")[0].as_py()

        names = texts.groupBy("slice").applyInArrow(lambda t: _table(list(_Slice(t, cover, ranges).requests(id_of(t))), request), _REQUEST)
        answers = self._resolve(names, "names")

        def around(t: pa.Table, found: pa.Table) -> pa.Table:
            return _table(_Slice(t, cover, ranges).stretches(id_of(t), found) if len(found) else [], stretches)

        left = texts.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(around, _STRETCHES)
        left = written(self.spark, left, f"{self.scratch}/stretches")

        def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(len(batch)):
                    one = _Stretches(pa.Table.from_batches([batch.slice(i, 1)]), cover, ranges)
                    yield from _table(list(one.piece_requests()), request).to_batches()

        answers = self._resolve(map_batches(left, pieces_of, _REQUEST), "pieces")

        def suffixes_of(t: pa.Table, found: pa.Table) -> pa.Table:
            return _table(list(_Stretches(t, cover, ranges).suffix_requests(found)), request)

        wanted = left.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(suffixes_of, _REQUEST)
        answers = answers.unionByName(self._resolve(wanted, "suffixes"))

        def removed_of(t: pa.Table, found: pa.Table) -> pa.Table:
            return _table(_Stretches(t, cover, ranges).removed(found), removed)

        gone = left.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(removed_of, _REMOVED)
        return written(self.spark, gone, f"{self.scratch}/removed")

    def cut(self, texts: DataFrame, removed: DataFrame, schema: str) -> DataFrame:
        def cut_texts(t: pa.Table, gone: pa.Table) -> pa.Table:
            rows = t.sort_by("nth").combine_chunks()
            found = Texts.of(rows.column("text").combine_chunks())
            data, at = found.data, found.at
            change = np.zeros(len(data) + 1, np.int64)
            for row in gone.to_pylist():
                text = np.frombuffer(row["nth"], "<i4")
                for key, step in (("starts", 1), ("ends", -1)):
                    change += step * np.bincount(at[text] + np.frombuffer(row[key], "<i8"), minlength=len(change))
            goes = np.cumsum(change)[:-1] > 0
            total = np.concatenate([[0], np.cumsum(goes)])
            first = goes.copy()
            first[1:] &= ~goes[:-1]
            # A text's first byte starts a span, whatever is before it in the slice.
            opening = at[:-1][at[:-1] < len(data)]
            first[opening] = goes[opening]
            spans = np.concatenate([[0], np.cumsum(first)])
            kept = [data[a:b][~goes[a:b]].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            return pa.table(
                {
                    "doc_id": rows.column("doc_id"),
                    "n_bytes": np.diff(at).astype(np.int64),
                    "n_removed": (total[at[1:]] - total[at[:-1]]).astype(np.int64),
                    "n_spans": (spans[at[1:]] - spans[at[:-1]]).astype(np.int64),
                    "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
                    "kept": pa.array(kept, pa.binary()),
                }
            )

        return texts.groupBy("slice").cogroup(removed.groupBy("slice")).applyInArrow(cut_texts, schema)
