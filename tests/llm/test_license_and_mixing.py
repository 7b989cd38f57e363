from __future__ import annotations

import math
from collections import defaultdict

import pytest
from llm_helpers import ALNUM, LOWER, SCHEMA, SPACED
from pyspark.sql import functions as F

from orderloom.llm.license_scan import PHRASES, Scanner, scan
from orderloom.llm.mixing import mix, source_targets


def expected_base(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = ALNUM.findall((text or "").translate(LOWER))
        places = [(i, label) for label, p in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        out.append((doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), labels))
    return sorted(out, key=str)


def scanned(documents):
    return sorted(map(tuple, scan(documents).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=str)


def test_phrases(spark, odd, odd_rows, empty):
    assert scanned(odd) == expected_base(odd_rows)
    rows = [(i, t, "", "", 0) for i, t in enumerate(["mit", "license", "mit license", "MIT,LICENSE mit license", "the mit licenses", "x mit license", "general public", "license general public license apache license", "mit\x00license", "mité license"])]
    assert scanned(spark.createDataFrame(rows, SCHEMA)) == expected_base(rows)
    assert scan(empty).count() == 0


def test_notices_with_errors(spark):
    texts = {
        0: "Foo. Relesed under the MIT licence; bar",
        1: "a b Licensed under the Apachy License, Version 2.0",
        2: "licensed under CC BY-NC 4.0",
        3: "released under some other terms",
        4: "Redistribution and use in sorce and binary forms, with or without modifications, are permitted.",
        5: "mit license",
        6: "released under the",
    }
    found = {r["doc_id"]: r for r in scan(spark.createDataFrame([(i, t, "", "", 0) for i, t in texts.items()], SCHEMA)).collect()}
    assert {i: r["labels"] for i, r in found.items()} == {0: "mit", 1: "apache", 2: "cc-by-nc", 3: "", 4: "bsd", 5: "mit", 6: ""}
    assert [(s["label"], s["first_word"], s["last_word"], s["errors"]) for s in found[0]["spans"]] == [("mit", 1, 5, 2)]
    assert found[1]["spans"][0]["first_word"] == 2 and found[1]["spans"][0]["errors"] == 1
    assert found[5]["score"] == 1.0 and found[3]["score"] == 0.0 and 0.8 < found[0]["score"] < 1
    assert found[0]["base_labels"] == "" and found[5]["base_labels"] == "mit"


def test_near_misses_of_other_licences():
    texts = {
        "licensed under cc by sa 4 0": ["cc-by-sa"],
        "licensed under cc by nd 4 0": ["cc-by-nd"],
        "licensed under cc by nc 4 0": ["cc-by-nc"],
        "licenced under cc by nc 4 0": ["cc-by-nc"],
        "licensed under cc by nc sa 4 0": ["cc-by-nc-sa"],
        "licensed under cc by nx 4 0": [],
        "released under the mpl license": ["mpl"],
        "released under the smith license": [],
        "released under the nit license": [],
        "relesed under the mit licence": ["mit"],
        "released under themit license": ["mit"],
        "licensed under the creative commons attribution 4 0": ["cc-by"],
        "licensed under the creative commons atribution share alike 4 0": ["cc-by-sa"],
        "licensed under the creative commons attribution noncommercial noderivs": ["cc-by-nc-nd"],
        "subject to the terms of the nokia public license": [],
        "permission is hereby not granted free of charge to any person obtaining a copy": [],
        "redistribution and use in source and binary forms with or without modification are not permitted": [],
        "redistribution and use in source and binary forms without modification are permitted": [],
        "gnu lesser general public license version": ["lgpl"],
        "licensed under the gnu general public license version": ["gpl"],
        "relesed under the mit license licensed under the apachy license version 2 0": ["mit", "apache"],
    }
    scanner = Scanner()
    for around in (b"%s \n", b"a b %s c d \n"):
        found = {t: [s[0] for s in scanner.notice_spans(around % t.encode())] for t in texts}
        assert found == texts


def fill(sizes, weights, budget):
    """Targets by sharing the excess again and again."""
    target = {s: 0.0 for s in sizes}
    left, open_ = budget, set(sizes)
    while left > 1e-9 and open_:
        total = sum(weights[s] for s in open_)
        for s in list(open_):
            target[s] += left * weights[s] / total
        left = sum(max(0, target[s] - 2 * sizes[s]) for s in open_)
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2 * sizes[s]
                open_.discard(s)
    return target


def test_targets_share_the_excess(spark):
    sizes = {"a": 1000, "b": 10, "c": 700, "d": 0, "e": 3000, "f": 50, None: 400}
    names = [*sorted(k for k in sizes if k is not None), None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    totals = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "source string, source_size bigint, n bigint")
    found = {r["source"]: r["target"] for r in source_targets(totals, (5, 2, 1), 1.5, 2.0).collect()}
    want = fill(sizes, weights, 1.5 * sum(sizes.values()))
    assert found == pytest.approx(want)


def check_mix(rows, result):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(SPACED.findall(r[1] or ""))
    taken, target = defaultdict(int), {}
    for r in result:
        assert r["size"] == len(SPACED.findall(r["text"] or ""))
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    for s, t in target.items():
        largest = max(len(SPACED.findall(r[1] or "")) for r in rows if r[3] == s)
        # Rows of one doc_id are taken together.
        assert abs(taken[s] - t) <= 2 * largest
    return taken


def test_mix_of_odd_rows(odd, odd_rows, empty):
    keep = ["doc_id", "source", "text"]
    first = mix(odd, keep=keep).collect()
    assert len(first) == len(odd_rows)
    check_mix(odd_rows, first)
    assert sorted(map(str, first)) == sorted(map(str, mix(odd.repartition(5), keep=keep).collect()))
    assert mix(empty).count() == 0


def test_large_source_is_sorted_in_ranges(spark, monkeypatch):
    from orderloom.llm import mixing

    rows = [(i, "word " * (1 + i % 7), "", "big" if i % 5 else f"s{i % 3}", 0) for i in range(2000)]
    documents = spark.createDataFrame(rows, SCHEMA)
    whole = {r["doc_id"]: r["taken"] for r in mix(documents).collect()}
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    assert {r["doc_id"]: r["taken"] for r in mix(documents).collect()} == whole
    monkeypatch.setattr(mixing, "SMALL_ROWS", 0)
    assert {r["doc_id"]: r["taken"] for r in mix(documents).collect()} == whole
    check_mix(rows, mix(documents, keep=["doc_id", "source", "text"]).collect())
    # Cleaner texts come first more often.
    rows = [(i, ("ab " if i % 2 else "#$%& ") * 20, "", "x" if i < 1000 else "y", 0) for i in range(2000)]
    clean = mix(spark.createDataFrame(rows, SCHEMA), budget=0.3).groupBy(F.col("doc_id") % 2).agg(F.sum("taken")).collect()
    by = {r[0]: r[1] for r in clean}
    assert by[1] > 1.5 * by[0]


def test_low_and_uneven_weights(spark, monkeypatch):
    """Weights from a column: the cut equals that of one whole sort, whatever range is sorted at once."""
    from orderloom.llm import mixing
    from orderloom.llm.spread import unit

    given = [0.2, 0.2, 0.01, 1.0, None, float("nan"), -3.0, 0.2]
    rows = [(i, "word " * (i % 5), "", "big" if i % 7 else None, i, given[i % 8]) for i in range(3000)]
    rows += [(9, "twice over", "", "big", 0, 0.2)] * 400 + [(None, "no id", "", "big", 0, 0.2)] * 300
    documents = spark.createDataFrame(rows, f"{SCHEMA}, `weigh it` double")
    draws = {r["doc_id"]: r["u"] for r in documents.select("doc_id", unit(F.col("doc_id")).alias("u")).distinct().collect()}

    def weight(w):
        return w if w is not None and w >= mixing.LEAST_WEIGHT else mixing.LEAST_WEIGHT

    def taken():
        found = mix(documents, ["doc_id", "source", "text", "weigh it"], budget=0.4, quality="weigh it")
        return sorted(((r["source"] or "", r["doc_id"] or -1, r["text"], r["copies"], r["target"]) for r in found.collect()), key=str)

    whole = taken()
    targets = {s: t for s, _, _, _, t in whole}
    want = []
    for source in ("big", ""):
        mine = sorted(
            (-math.log(draws[r[0]]) / weight(r[5]), -1 if r[0] is None else r[0], r[1]) for r in rows if (r[3] or "") == source
        )
        groups = defaultdict(list)
        for key, doc_id, text in mine:
            groups[key, doc_id].append(text)
        upto = 0
        for (_, doc_id), found in sorted(groups.items()):
            size = sum(len(t.split()) for t in found)
            copies = int(upto + size / 2 <= targets[source])
            want += [(source, doc_id, t, copies, targets[source]) for t in found]
            upto += size
    assert whole == sorted(((s, d or -1, t, k, x) for s, d, t, k, x in want), key=str)
    for most, digit in ((100, 12), (1, 4)):
        monkeypatch.setattr(mixing, "RANGE_ROWS", most)
        monkeypatch.setattr(mixing, "_DIGIT", digit)
        assert taken() == whole
