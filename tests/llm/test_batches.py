from __future__ import annotations

import numpy as np
import pyarrow as pa
from llm_helpers import ALNUM, LOWER, SPACED

from orderloom.llm import batches
from orderloom.llm.batches import ALPHANUMERIC, Texts, pieces, sums
from orderloom.llm.spread import KeyFilter, attach


def _words(kind, texts, lower):
    found = Texts.of(pa.array(texts, pa.string()))
    found = (found.lower() if lower else found).words(kind)
    flat = [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends, strict=True)]
    distinct = found.distinct
    assert [distinct[c].decode() for c in found.codes] == flat
    return [flat[a:b] for a, b in zip(found.at[:-1], found.at[1:], strict=True)]


def test_words_are_those_of_the_patterns(odd_rows):
    texts = [r[1] for r in odd_rows] + ["a\x1cb\x85c　d", "é.É_ß-9", None, "", "end", "start"]
    assert _words(batches.SPACED, texts, False) == [SPACED.findall(t or "") for t in texts]
    assert _words(ALPHANUMERIC, texts, True) == [ALNUM.findall((t or "").translate(LOWER)) for t in texts]
    assert _words(batches.SPACED, [], False) == []
    assert _words(batches.SPACED, [None, ""], False) == [[], []]


def test_slices_of_arrays_and_batches():
    column = pa.array(["skipped", "a b", None, "c"])[1:]
    assert [Texts.of(column).one(i) for i in range(3)] == [b"a b", b"", b"c"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 5_000_000, None, "y" * 5_000_000, "z"])], names=["text"])
    assert [p.num_rows for p in pieces(batch)] == [2, 2]
    assert sums(np.array([1, 2, 3, 4]), np.array([0, 0, 3, 4])).tolist() == [0, 6, 4]


def test_attach_keeps_hot_and_rare_keys(spark):
    many = spark.createDataFrame([(1, i) for i in range(500)] + [(k, 0) for k in range(2, 30)], "k bigint, v bigint")
    one = spark.createDataFrame([(1, 500, "hot")] + [(k, 1, "rare") for k in range(2, 20)], "k bigint, n bigint, w string")
    assert attach(many, one, ["k"], "n", 528).count() == 518
    left = attach(many, one, ["k"], "n", 528, how="left")
    assert left.count() == 528
    assert left.where("w is null").count() == 10


def test_key_filter_misses_none(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(10**12, 10**12 + 1000)]
    found = KeyFilter.of(spark.createDataFrame([(k,) for k in keys], "k bigint"), "k")
    assert found.may_hold(np.array(keys, np.int64)).all()
    assert not found.may_hold(np.arange(5000, 6000)).any()
    assert not KeyFilter.of(spark.createDataFrame([], "k bigint"), "k").may_hold(np.array([1, 2])).any()
