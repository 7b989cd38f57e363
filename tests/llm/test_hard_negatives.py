"""Hard negatives against a comparison of every anchor with every row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import hard_negatives as hn
from orderloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score double, floor int"


def _usable(rows):
    out = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        out.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    return out


def _expected(rows, every=50):
    rows = _usable(rows)
    out = []
    for i, (anchor, label, a) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), v_id is None, v_id or 0, l == label) for j, (v_id, l, v) in enumerate(rows) if j != i]
        scored.sort()
        for score, none, p_id, _ in [s for s in scored if s[3]][:5]:
            ps = -score
            fits = [s for s in scored if not s[3] and 50 * ps <= -100 * s[0] <= 95 * ps][:3]
            for rank, (ns, n_none, n_id, _) in enumerate(fits, 1):
                out.append((anchor, None if none else p_id, rank, None if n_none else n_id, ps, -ns))
    return sorted(out, key=repr)


def _found(spark, rows, every=50):
    df = spark.createDataFrame([(*r, "x", 1.0, 2) for r in rows], SCHEMA).repartition(3)
    return _of(df, every)


def _of(df, every=50):
    q = hn.quantized(df).withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    found = hn.hard_negatives(q, F.col("vec_id") % every == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def _clustered(rng, n, width=6):
    """Rows around few directions, so that lists end early; ties and copies among them."""
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        k = rng.randrange(4)
        vector = [x + rng.gauss(0, 0.05) for x in centres[k]]
        if rng.random() < 0.3:
            vector = [round(x, 1) for x in centres[k]]
        rows.append((i, vector, rng.choice((k, k, (k + 1) % 4))))
    return rows


@pytest.mark.parametrize("per_cluster", [256, 4])
def test_clusters_against_all_pairs(spark, monkeypatch, per_cluster):
    # Small clusters, groups and steps: many lists, several groups of members, several steps of a walk.
    for name, value in (("PER_CLUSTER", per_cluster), ("GROUP", per_cluster), ("_STEP", 16 if per_cluster == 4 else 512)):
        monkeypatch.setattr(hn, name, value)
    rows = _clustered(random.Random(per_cluster), 400)
    assert _found(spark, rows, 10) == _expected(rows, 10) != []


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = _clustered(rng, 60)
    rows += [
        (None, rows[3][1], 1), (None, rows[3][1], 2), (100, None, 1), (150, rows[3][1], None),
        (200, [0.1, None], 1), (250, [float("nan")] * 6, 1), (300, [float("inf")] * 6, 1), (350, [], 1), (400, [0.0] * 6, 2),
        (450, [0.5, 0.25], 1), (50, rows[50][1], rows[50][2]), (-50, rows[5][1], -3), (500, [-x for x in rows[7][1]], 0),
    ]
    assert _found(spark, rows) == _expected(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((1e6, -1e6, 300.0)) * rng.random() for _ in range(3)], i % 3) for i in range(60)]
    assert _found(spark, rows, 20) == _expected(rows, 20)


def test_no_anchor_and_empty_table(spark):
    assert _found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert _of(spark.createDataFrame([], SCHEMA)) == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_hard_negatives"](spark, sf_dir).collect()), key=repr)
    assert found == _expected(rows) != []
