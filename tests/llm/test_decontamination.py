from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
from llm_helpers import ALNUM, LOWER, SCHEMA, prose

from orderloom.llm import decontamination
from orderloom.llm.batches import ALPHANUMERIC, Texts
from orderloom.llm.decontamination import Patterns, contamination, digest


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def expected(rows, items):
    patterns = {}
    for item_id, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            patterns.setdefault(tuple(w[i : i + k]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        hit, names = set(), set()
        for k in {len(p) for p in patterns}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in patterns:
                    hit.update(range(i, i + k))
                    names |= patterns[tuple(w[i : i + k])]
        joined = ",".join(sorted(names))
        out.append((doc_id, len(w), len(hit), sorted(names), bool(hit), hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def found(documents, benchmark):
    result = contamination(documents, benchmark).withColumn("sha", digest())
    return sorted(map(tuple, result.collect()), key=str)


def cases():
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randint(5, 40))) for i in range(25)]
    # Short items, one word, no word, null, repeats, an item in another.
    items += [(30, "one two"), (31, "solo"), (32, "?!"), (33, None), (34, items[0][1]), (0, items[1][1]), (None, "q r s t")]
    items += [(35, " ".join(words(items[2][1])[3:16]))]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            item = words(rng.choice(items)[1])
            start = rng.randint(0, max(0, len(item) - 8))
            parts += [" ".join(item[start : start + rng.randint(5, 14)]).upper(), prose(rng, 5)]
        rows.append((i, rng.choice((" ", "--", "\n")).join(parts), "", "", 0))
    rows.append((99, "q, R; s!! T", "", "", 0))
    rows.append((100, prose(rng, 5000) + " " + (items[3][1] or "") + prose(rng, 5000) + (items[4][1] or ""), "", "", 0))
    return rows, items


def test_all_occurrences(spark):
    rows, items = cases()
    result = found(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string"))
    assert result == expected(rows, items)


def test_a_large_benchmark_takes_several_passes(spark, monkeypatch):
    rows, items = cases()
    monkeypatch.setattr(decontamination, "PASS_BYTES", 1500)
    result = found(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string"))
    assert result == expected(rows, items)


def test_odd_rows_and_empty_tables(spark, odd, odd_rows, empty):
    items = [(1, "one two"), (2, "general public license")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(odd, benchmark) == expected(odd_rows, items)
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert found(odd, nothing) == expected(odd_rows, [])
    assert found(empty, benchmark) == []


def test_a_common_pair_costs_no_more_than_others():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    n = 4000

    def texts(common):
        pair = ["of", "the"]
        items = []
        for i in range(n):
            row = rng.choices(vocabulary, k=12)
            for j in (2, 8):
                row[j : j + 2] = pair if common else rng.choices(vocabulary, k=2)
            items.append((str(i), " ".join(row)))
        document = [w for _ in range(10_000) for w in [*rng.choices(vocabulary, k=8), *(pair if common else rng.choices(vocabulary, k=2))]]
        return items, " ".join([*document, items[7][1], "x", items[9][1]])

    seconds = []
    for common in (False, True):
        items, document = texts(common)
        patterns = Patterns(items)
        words = Texts.of(pa.array([document])).words(ALPHANUMERIC)
        took = []
        for _ in range(3):
            start = time.perf_counter()
            hit, _, item = patterns.hits(words)
            took.append(time.perf_counter() - start)
        assert hit.sum() == 24
        assert sorted(item.tolist()) == [7, 9]
        seconds.append(min(took))
    # Positions with the pair are looked at, others skipped: a small factor, not the size of a bucket.
    assert seconds[1] < 10 * seconds[0] + 0.2


def test_windows_with_one_place_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontamination, "_prefix", lambda columns, n: np.zeros(n, np.uint64))
    tail = "k l"
    items = [(str(i), f"a{i % 3} b{i} {tail}") for i in range(6)] + [("6", f"a0 b0 {tail}")]
    patterns = Patterns(items)
    words = Texts.of(pa.array(["a1 b4 k l", "a1 b5 k l", "a0 b0 k l"])).words(ALPHANUMERIC)
    hit, text, item = patterns.hits(words)
    assert hit.tolist() == [True] * 4 + [False] * 4 + [True] * 4
    assert list(zip(text.tolist(), item.tolist())) == [(0, 4), (2, 0), (2, 6)]
