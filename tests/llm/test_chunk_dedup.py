from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
from llm_helpers import LOWER, SCHEMA, prose

from orderloom.llm.batches import Texts
from orderloom.llm.chunk_dedup import MAX_CHUNK, cuts, exact_groups


def expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    out = []
    for doc_id, text, *_ in rows:
        normal = (text or "").translate(LOWER)
        sha = hashlib.sha256(normal.encode()).hexdigest()
        out.append((doc_id, keep[normal], len(groups[normal]), doc_id == keep[normal], sha))
    return sorted(out, key=str)


def found(documents, **more):
    result = exact_groups(documents, **more).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted(map(tuple, result.collect()), key=str)


def test_odd_rows(odd, odd_rows):
    assert found(odd) == expected(odd_rows)


def test_contents_decide_where_fingerprints_are_equal(spark, odd, odd_rows):
    # With 3 bits nearly all chunks share their fingerprint with others.
    assert found(odd, bits=3) == expected(odd_rows)
    rng = random.Random(1)
    parts = [prose(rng, 900) for _ in range(4)]
    rows = [(i, "".join(rng.choices(parts, k=3)), "", "", 0) for i in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA), bits=2) == expected(rows)


def test_empty_table(empty):
    assert found(empty) == []


def test_large_group(spark):
    rows = [(i, "same text", "", "", 0) for i in range(3000)] + [(5000 + i, f"own {i}", "", "", 0) for i in range(100)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_cuts_follow_content_and_cover_the_text():
    rng = np.random.default_rng(5)
    body = rng.integers(97, 123, 200_000).astype(np.uint8).tobytes()
    texts = [body, b"in front " + body, b"", b"a" * (3 * MAX_CHUNK + 1), b"z"]
    t = Texts.of(pa.array(texts, pa.binary()))
    ends, n = cuts(t.data, t.at)
    chunks, place = [], 0
    for e in ends.tolist():
        chunks.append(t.data[place:e].tobytes())
        place = e
    lists = [chunks[a:b] for a, b in zip(np.cumsum(n) - n, np.cumsum(n), strict=True)]
    assert [b"".join(x) for x in lists] == texts
    assert all(len(c) <= MAX_CHUNK for c in chunks)
    # An insertion changes the chunks around it only.
    assert len(set(lists[0]) & set(lists[1])) >= len(lists[0]) - 2 > 50
