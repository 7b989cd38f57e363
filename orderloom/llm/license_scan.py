"""Short licence notices in whole texts, also with errors.

A notice that occurs with at most k errors holds at least one of its k + 1 parts
unchanged. The parts are searched as they are; where one is found, the regex
library matches the notice with bounded errors around it and gives the span.

Errors are not spread freely: words that tell licences apart (KEYS) have a bound
of their own, and of notices that overlap the one with the most right letters counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from orderloom.llm.batches import ALPHANUMERIC, Texts, Words, map_texts

# Labels and the phrases whose places are counted.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# Labels and notices that are searched with errors, as words.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version"),
    ("lgpl", "gnu lesser general public license version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("all-rights-reserved", "all rights reserved no part of this"),
)
# Notices of other licences that come close to those above.
SIBLINGS = (
    ("mpl", "released under the mpl license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc-by-sa", "licensed under the creative commons attribution sharealike"),
    ("cc-by-nd", "licensed under the creative commons attribution noderivatives"),
    ("cc-by-nd", "licensed under the creative commons attribution noderivs"),
    ("cc-by-nc", "licensed under the creative commons attribution noncommercial"),
    ("cc-by-nc-sa", "licensed under the creative commons attribution noncommercial sharealike"),
    ("cc-by-nc-nd", "licensed under the creative commons attribution noncommercial noderivatives"),
    ("cc-by-nc-nd", "licensed under the creative commons attribution noncommercial noderivs"),
)
# Words of notices that tell licences apart, or grant from refusal.
KEYS = (
    "mit", "mpl", "apache", "gnu", "lesser", "general public", "mozilla", "cc by", "sa", "nd", "nc",
    "attribution", "sharealike", "noderivatives", "noderivs", "noncommercial",
    "is hereby granted", "free of charge", "with or without", "are permitted", "all rights reserved",
)
#: Letters of a notice per error that is allowed, and letters of a key: shorter keys are exact.
LETTERS_PER_ERROR, KEY_LETTERS_PER_ERROR = 12, 6


@dataclass(frozen=True)
class Notice:
    label: str
    text: bytes
    errors: int

    @property
    def parts(self) -> list[tuple[int, bytes]]:
        """errors + 1 parts with their places; a match has one of them unchanged."""
        n = self.errors + 1
        at = [len(self.text) * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def pattern(self) -> regex.Pattern:
        return regex.compile(rb"(?e)(?:" + regex.escape(self.text) + rb"){e<=%d}" % self.errors)

    def keys(self, keys: Sequence[str]) -> list[regex.Pattern]:
        """A pattern for each key of the notice: it stands alone, or a space to the next word is missing."""
        out = []
        for key in (k.encode() for k in keys):
            for m in regex.finditer(rb"(?<![^ ])" + key + rb"(?![^ ])", self.text):
                before, after = self.text[: m.start()].split(), self.text[m.end() :].split()
                left = rb"|".join([rb"^| ", *before[-1:]])
                right = rb"|".join([rb"$| ", *after[:1]])
                out.append(regex.compile(rb"(?:%s)(?:%s){e<=%d}(?:%s)" % (left, key, len(key) // KEY_LETTERS_PER_ERROR, right)))
        return out


class Scanner:
    def __init__(
        self,
        phrases: Sequence[tuple[str, str]] = PHRASES,
        notices: Sequence[tuple[str, str]] = NOTICES + SIBLINGS,
        keys: Sequence[str] = KEYS,
    ):
        self.phrases = [(label, phrase.encode()) for label, phrase in phrases]
        self.notices = [Notice(label, text.encode(), len(text) // LETTERS_PER_ERROR) for label, text in notices]
        self.patterns = [n.pattern() for n in self.notices]
        self.keys = [n.keys(keys) for n in self.notices]

    def phrase_places(self, stream: bytes, at: np.ndarray) -> list[tuple[str, int]]:
        """Label and first word of every place of a phrase."""
        found = []
        for label, phrase in self.phrases:
            for place in _places(stream, phrase):
                end = place + len(phrase)
                if (place == 0 or stream[place - 1] in _BREAKS) and stream[end] in _BREAKS:
                    found.append((label, int(np.searchsorted(at, place))))
        return found

    def notice_spans(self, stream: bytes) -> list[tuple[str, int, int, int, float]]:
        """Label, first and last byte, errors and likeness of every notice found; of overlapping ones the best."""
        found = []
        for notice, pattern, keys in zip(self.notices, self.patterns, self.keys, strict=True):
            reach = len(notice.text) + notice.errors
            windows = sorted(
                (max(0, place - offset - notice.errors), place - offset + reach)
                for offset, part in notice.parts
                for place in _places(stream, part)
            )
            for start, end in _joined(windows):
                # A notice ends with its text.
                for lo, hi in _lines(stream, start, min(end, len(stream))):
                    for m in pattern.finditer(stream, lo, hi):
                        errors = sum(m.fuzzy_counts)
                        whole = _whole_words(stream, m.start(), m.end())
                        if all(key.search(whole) for key in keys):
                            span = (notice.label, m.start(), m.end() - 1, errors, 1 - errors / len(notice.text))
                            found.append((len(notice.text) - errors, span))
        found.sort(key=lambda x: (x[1][1], -x[0]))
        best: list[tuple[int, tuple]] = []
        for right, span in found:
            # Overlapping notices of different licences claim the same words: fewer right letters give way.
            while best and span[1] <= best[-1][1][2] and right > best[-1][0]:
                best.pop()
            if not best or span[1] > best[-1][1][2]:
                best.append((right, span))
        return [span for _, span in best]


_BREAKS = b" \n"


def _places(stream: bytes, part: bytes):
    place = stream.find(part)
    while place >= 0:
        yield place
        place = stream.find(part, place + 1)


def _whole_words(stream: bytes, start: int, end: int) -> bytes:
    """The bytes from start to end with what is left of their first and last word."""
    space = stream.rfind(b" ", 0, start)
    start = max(space, stream.rfind(b"\n", space + 1, start)) + 1
    space = stream.find(b" ", end - 1)
    space = len(stream) if space < 0 else space
    line = stream.find(b"\n", end - 1, space)
    return stream[start : space if line < 0 else line].strip(_BREAKS)


def _joined(windows: list[tuple[int, int]]):
    """Overlapping windows as one."""
    last = None
    for start, end in windows:
        if last and start <= last[1]:
            last = (last[0], max(last[1], end))
        else:
            if last:
                yield last
            last = (start, end)
    if last:
        yield last


def _lines(stream: bytes, start: int, end: int):
    while start < end:
        stop = stream.find(b"\n", start, end)
        stop = end if stop < 0 else stop
        yield start, stop
        start = stop + 1


def word_stream(words: Words) -> tuple[bytes, np.ndarray]:
    """All words, a space after each and a line break after a text's last; and where words begin."""
    size = words.ends - words.starts
    at = np.cumsum(size + 1) - (size + 1)
    stream = np.full(int((size + 1).sum()), 32, np.uint8)
    inner = np.ones(len(stream), bool)
    inner[at + size] = False
    stream[inner] = words.data[np.repeat(words.starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
    final = words.at[1:][words.counts > 0] - 1
    stream[at[final] + size[final]] = 10
    return stream.tobytes(), at


def scan(documents: DataFrame, scanner: Scanner | None = None, keep=("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every document and the licences that it names.

    n_words; n_base, first_word, last_word (places of phrases: how many, smallest
    and largest first word, null if none); base_labels and labels (comma-joined,
    distinct, in order); score (1 for a phrase, else the likeness of the best
    notice, else 0); spans (label, first_word, last_word, errors of each notice).
    Null or empty text has no words and no labels. Texts are read whole; a
    notice never reaches from one text into the next.
    """
    shared = documents.sparkSession.sparkContext.broadcast(scanner or Scanner())

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        words = Texts.of(batch.column("text")).lower().words(ALPHANUMERIC)
        stream, at = word_stream(words)
        n = len(batch)
        base: list[list[tuple[str, int]]] = [[] for _ in range(n)]
        spans: list[list[dict]] = [[] for _ in range(n)]
        score = np.zeros(n)
        text_of = lambda word: int(np.searchsorted(words.at, word, side="right")) - 1
        for label, word in shared.value.phrase_places(stream, at):
            t = text_of(word)
            base[t].append((label, word - int(words.at[t])))
            score[t] = 1.0
        for label, start, end, errors, likeness in shared.value.notice_spans(stream):
            first, last = (int(np.searchsorted(at, x, side="right")) - 1 for x in (start, end))
            t = text_of(first)
            origin = int(words.at[t])
            spans[t].append({"label": label, "first_word": first - origin, "last_word": last - origin, "errors": errors})
            score[t] = max(score[t], likeness)
        starts = [[w for _, w in row] for row in base]
        labels = [{x for x, _ in row} for row in base]
        return [
            pa.array(words.counts),
            pa.array([len(x) for x in starts], pa.int64()),
            pa.array([min(x, default=None) for x in starts], pa.int64()),
            pa.array([max(x, default=None) for x in starts], pa.int64()),
            pa.array([",".join(sorted(x)) for x in labels], pa.string()),
            pa.array([",".join(sorted(x | {s["label"] for s in row})) for x, row in zip(labels, spans, strict=True)], pa.string()),
            pa.array(score),
            pa.array([sorted(row, key=lambda s: (s["first_word"], s["label"])) for row in spans], _SPANS),
        ]

    return map_texts(documents, work, _SCHEMA, keep)


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int64())]))
_SCHEMA = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
    "spans array<struct<label: string, first_word: bigint, last_word: bigint, errors: bigint>>"
)
