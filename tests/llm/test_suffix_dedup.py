"""Repeated passages against a search of every string in plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from llm_helpers import SCHEMA, prose

from orderloom.llm.queries import QUERIES
from orderloom.llm.suffix_dedup import _COVERS, Cover, repeated_passages


def _expected(rows, length):
    first = {}
    for doc, text in rows:
        data, doc = (text or "").encode(), -(1 << 63) if doc is None else doc
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            first[s] = min(doc, first.get(s, doc))
    out = []
    for doc, text in rows:
        data, key = (text or "").encode(), -(1 << 63) if doc is None else doc
        goes = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < key:
                goes[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, goes, strict=True) if not g)
        spans = sum(g and not (i and goes[i - 1]) for i, g in enumerate(goes))
        out.append((doc, len(data), sum(goes), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def _found(df):
    return sorted((tuple(r[:5]) + (bytes(r[5]),) for r in df.collect()), key=repr)


@pytest.mark.parametrize("period", sorted(_COVERS))
def test_residues_cover_all_differences(period):
    residues = _COVERS[period]
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))


def test_cover_follows_the_length():
    assert (Cover.of(50).period, Cover.of(50).triple) == (21, 30)
    assert Cover.of(6).period == 3
    with pytest.raises(ValueError):
        Cover.of(5)


def test_odd_rows(odd, odd_rows):
    found = repeated_passages(odd, slice_bytes=1 << 16)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert _found(found) == _expected([r[:2] for r in odd_rows], 50)


@pytest.mark.parametrize("hot_slices", [0, 1000])
def test_copies_with_edits_and_shared_passages(spark, hot_slices):
    """Many documents around few passages, of lengths near the limit; all names are hot, or none."""
    rng = random.Random(hot_slices)
    passages = [prose(rng, 40)[:n] for n in (11, 12, 13, 14, 30, 60, 200)]
    rows = []
    for doc in rng.sample(range(500), 120):
        parts = [rng.choice((rng.choice(passages), prose(rng, rng.randint(0, 6)), "a" * rng.randint(0, 30), "\0" * rng.randint(0, 15))) for _ in range(rng.randint(0, 8))]
        rows.append((doc if rng.random() < 0.97 else None, "".join(parts)))
    base = prose(rng, 80)
    for doc in range(600, 640):
        at = rng.randrange(len(base))
        rows.append((doc, base[:at] + rng.choice("xyz") + base[at + 1 :]))
    rows += [(700, base), (701, base), (701, base), (702, None)]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], SCHEMA).repartition(5)
    assert _found(repeated_passages(df, 12, 2000, hot_slices)) == _expected(rows, 12)


def test_empty_table(empty):
    assert repeated_passages(empty).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op12_suffix_dedup"](spark, sf_dir).collect()), key=repr)
    assert found == sorted((r[:5] for r in _expected(rows, 50)), key=repr)
