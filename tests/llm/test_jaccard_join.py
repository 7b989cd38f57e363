from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_helpers import LOWER, SCHEMA, SPACED, prose
from pyspark.sql import functions as F

from orderloom.llm import jaccard_join
from orderloom.llm.components import connected_components
from orderloom.llm.jaccard_join import (
    Limits,
    Region,
    _may_be_in,
    from_varints,
    one_of_each,
    packed_counts,
    set_classes,
    similar_groups,
    summed_counts,
    varints,
)
from orderloom.scratch import written

#: Every region with more than a few documents is too large for a task.
TINY = Limits(hashes=600, classes=4, pivots=2, rounds=2, pivot_bytes=4000)


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b) and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    return sets, group


def expected(rows):
    sets, group = components(rows)
    smallest = {}
    for g, r in zip(group, rows, strict=True):
        if r[0] is not None:
            smallest[g] = min(smallest.get(g, r[0]), r[0])
    return sorted(((r[0], len(s), smallest.get(g)) for r, s, g in zip(rows, sets, group, strict=True)), key=str)


def found(documents, **more):
    result = similar_groups(documents, **more).select("doc_id", "n_shingles", "component_id")
    return sorted(map(tuple, result.collect()), key=str)


def chains(seed, n_families, size):
    """Families of texts that drift apart, so that ends are linked by chains only; passages in many of them."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    rows = []
    for _ in range(n_families):
        text = SPACED.findall(prose(rng, rng.choice((8, 60, 150))))
        for _ in range(rng.randint(1, size)):
            text = list(text)
            for _ in range(rng.randint(0, 1 + len(text) // 40)):
                text[rng.randrange(len(text))] = prose(rng, 1).strip()
            rows.append(" ".join(text) + (" " + passage if rng.random() < 0.3 else ""))
    rng.shuffle(rows)
    return [(i, t, "", "", 0) for i, t in enumerate(rows)]


def test_families(spark):
    rows = chains(1, 20, 8)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_regions_that_do_not_fit_a_task(spark):
    rows = chains(2, 4, 12)
    assert found(spark.createDataFrame(rows, SCHEMA), limits=TINY) == expected(rows)


def test_odd_rows_and_empty_table(odd, odd_rows, empty):
    assert found(odd) == expected(odd_rows)
    assert found(empty) == []
    assert one_of_each(empty).count() == 0


def test_one_of_each(odd, odd_rows):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    _, group = components(odd_rows)
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = []
    by_group = {}
    for g, r in zip(group, odd_rows, strict=True):
        by_group.setdefault(g, []).append(r)
    for rows in by_group.values():
        ids = [r[0] for r in rows if r[0] is not None]
        want.append(min((r[0], r[1]) for r in rows if r[0] == min(ids)) if ids else (None, rows[0][1]))
    assert left == sorted(want, key=str)


def test_ids_beyond_doubles_beside_null(spark):
    rng, big = random.Random(7), 2**53
    base = prose(rng, 80)
    texts = [(big, prose(rng, 80)), (big + 1, base), (None, prose(rng, 80)), (big + 3, base + " one more"), (big + 5, base + " or two")]
    rows = [(*r, "", "", 0) for r in texts]
    documents = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    asked = spark.createDataFrame([(big + 1,), (big + 3,)], "id bigint")
    may_be_in = documents.select("doc_id", _may_be_in(asked, "id")(F.col("doc_id")))
    assert {r[0]: r[1] for r in may_be_in.collect()} == {big: False, big + 1: True, None: True, big + 3: True, big + 5: False}
    assert found(documents) == expected(rows)
    assert sorted((r["doc_id"] for r in one_of_each(documents).collect()), key=str) == [big, big + 1, None]


@pytest.mark.parametrize("n", [2, 40, 150])
def test_a_region_connects_what_all_pairs_do(n):
    rng = np.random.default_rng(n)
    centres = [rng.choice(5000, 40, replace=False) for _ in range(1 + n // 10)]
    sets = []
    for _ in range(n):
        keep = rng.choice(centres[rng.integers(len(centres))], rng.integers(28, 41), replace=False)
        sets.append(np.unique(np.concatenate([keep, rng.integers(5000, 9000, rng.integers(0, 5))])))
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    region = Region(np.concatenate(sets), at, np.arange(n), 75)
    region.join(np.arange(n))
    group = list(range(n))
    for i, j in itertools.combinations(range(n), 2):
        common = len(np.intersect1d(sets[i], sets[j]))
        if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
            group = [group[i] if g == group[j] else g for g in group]
    linked = list(range(n))
    for i, j in region.pairs:
        linked = [linked[i] if g == linked[j] else g for g in linked]
    same = lambda g: {(i, j) for i in range(n) for j in range(n) if g[i] == g[j]}
    assert same(group) == same(linked)


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)]
    group = {}
    for a, b in edges:
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for k in y:
                group[k] = x
    result = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in result} == {k: min(v) for k, v in group.items() if len(v) > 1}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_counts_are_packed_and_summed():
    rng = np.random.default_rng(5)
    numbers = np.concatenate([[0, 127, 128, 16383, 16384, 2**36 - 1], rng.integers(0, 2**36, 100)])
    assert np.array_equal(from_varints(varints(numbers))[0], numbers)
    lots = [np.unique(rng.integers(0, 2**36, 3000)) for _ in range(3)]
    lots += [np.unique(np.concatenate([lots[0][::7], lots[1][::5], [0, 2**36 - 1]])) for _ in range(2)]
    counts = [rng.integers(1, 400, len(k)) for k in lots]
    rows = pa.Table.from_batches([packed_counts(k, n) for k, n in zip(lots, counts, strict=True)])
    want = {}
    for k, n in zip(lots, counts, strict=True):
        for key, m in zip(k.tolist(), n.tolist(), strict=True):
            want[key] = want.get(key, 0) + m
    found = {}
    for part in set(rows.column("part").to_pylist()):
        key, n = summed_counts(part, rows.filter(pc.equal(rows.column("part"), part)))
        found |= dict(zip(key.tolist(), n.tolist(), strict=True))
    assert found == {k: n for k, n in want.items() if n > 1}


@pytest.fixture
def tables(monkeypatch):
    """Rows of the tables that the join writes, by the last part of their path."""
    sizes = {}

    def and_counted(spark, df, path):
        df = written(spark, df, path)
        sizes[path.rpartition("/")[2]] = df.count()
        return df

    monkeypatch.setattr(jaccard_join, "written", and_counted)
    return sizes


def test_copies_do_not_make_shingles_common(spark, tables):
    """Documents that have some words in common meet no more often when there are copies of all."""
    rng = random.Random(11)
    passage = prose(rng, 12)
    rows = [(i, prose(rng, 40) + passage + prose(rng, 40), "", "", 0) for i in range(60)]
    copies = [(100 * k + r[0], *r[1:]) for k in range(4) for r in rows]
    documents = spark.createDataFrame(copies, SCHEMA).repartition(8, "doc_id")
    assert found(documents) == expected(copies)
    assert tables["counts"] < 100 and tables["members"] == 0 and tables["blocks"] == 0


def test_near_copies_do_not_make_shingles_common(spark, tables):
    """Documents that have some words in common meet no more often when there are near copies of all."""
    rng = random.Random(12)
    passage = prose(rng, 12)
    rows = []
    for i in range(30):
        text = prose(rng, 60) + passage + prose(rng, 60)
        rows += [(10 * i + k, text + f" ending{i} of{k} this{i}x{k}", "", "", 0) for k in range(4)]
    documents = spark.createDataFrame(rows, SCHEMA).repartition(8, "doc_id")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(jaccard_join, "FREQUENT", 4)
        assert found(documents, limits=Limits(classes=16)) == expected(rows)
    assert tables["blocks"] == 120 and "wide" not in tables


def test_sets_that_are_moved_to_their_regions(spark):
    rows = chains(3, 12, 8)
    rows += [(1000 + r[0], r[1].upper(), "", "", 0) for r in rows[::3]] + [(None, *rows[0][1:]), (rows[1][0], *rows[2][1:])]
    documents = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(documents) == expected(rows)
    assert found(documents, limits=Limits(known=0)) == expected(rows)
    tiny = {k: getattr(TINY, k) for k in ("hashes", "classes", "pivots", "rounds", "pivot_bytes")}
    assert found(documents, limits=Limits(**tiny, known=0)) == expected(rows)


def test_copies_are_not_shuffled_to_choose_one(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(i, prose(rng, 30), "", "", 0) for i in range(100)]
    copies = [(1000 * k + r[0], *r[1:]) for k in range(4) for r in rows] + [(3, *rows[3][1:]), (None, *rows[4][1:])]
    asked = []

    def and_counted(documents, *more):
        classes = set_classes(documents, *more)
        asked.append(classes.count())
        return classes

    monkeypatch.setattr(jaccard_join, "set_classes", and_counted)
    kept = one_of_each(spark.createDataFrame(copies, SCHEMA).repartition(4, "doc_id"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(100))
    assert asked[0] < 40
