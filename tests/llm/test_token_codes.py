from __future__ import annotations

import zlib

import numpy as np
import pytest

from orderloom.llm import token_codes
from orderloom.llm.length_histogram import length_histogram, totals_at
from orderloom.llm.token_codes import Packed, pack, token_table

tokenizers = pytest.importorskip("tokenizers")
PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [1, 200, 256, 49_408, 1 << 20, (1 << 32) - 1])
@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
def test_codes_give_back_every_id(top, n):
    ids = np.random.default_rng(n).integers(0, top, n, endpoint=True).astype(np.uint32)
    packed = Packed(pack(ids))
    assert packed.all().tolist() == ids.tolist()
    assert len(packed) == n
    for i in {0, 1, n // 2, n - 1, 510, 512} & set(range(n)):
        assert packed[i] == ids[i]
    with pytest.raises(IndexError):
        packed[n]


def expected(rows):
    encoder, start, out = tokenizers.Tokenizer.from_file(PATH), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=lambda r: r[1])


def found(documents):
    return sorted(map(tuple, token_table(documents, PATH, 1).collect()), key=lambda r: r[1])


def test_files_hold_all_ids_in_order(odd, odd_rows, monkeypatch):
    assert found(odd) == expected(odd_rows)
    monkeypatch.setattr(token_codes, "SEGMENT_IDS", 500)
    assert found(odd) == expected(odd_rows)


def test_text_that_holds_special_strings_and_marks(spark):
    texts = ["don't I'LL we've", "<|endoftext|> x<|startoftext|>y", "İstanbul ΣΑΣ σ", "x y　z", "12ab3.5!!??"]
    texts += ["ﬁn Å", " ́a é", "ÉCOLE, Ñandú; ÿ", "a\x1cb\x85c", "snake_case-like: [x]{y}`~"]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == expected(rows)


def test_empty_table(empty):
    assert found(empty) == []
    assert length_histogram(empty, PATH).count() == 0


def test_length_histogram(odd, odd_rows):
    encoder = tokenizers.Tokenizer.from_file(PATH)
    sizes = [len(encoder.encode(r[1] or "", add_special_tokens=False).ids) for r in odd_rows]
    result = length_histogram(odd, PATH)
    rows = {r["length"]: r for r in result.collect()}
    assert set(rows) == set(sizes)
    for length, r in rows.items():
        assert r["n_documents"] == sizes.count(length)
        assert r["longer_documents"] == sum(s > length for s in sizes)
        assert r["longer_tokens"] == sum(s for s in sizes if s > length)
        assert r["total_tokens"] == sum(sizes)
        assert r["kept_tokens"] == sum(min(s, length) for s in sizes)
        assert r["cut_tokens"] == sum(max(s - length, 0) for s in sizes)
        assert r["quantile"] == pytest.approx(sum(s <= length for s in sizes) / len(sizes))
    for limit in (0, 1, 50, 10**6):
        t = totals_at(result, limit).first()
        assert t["kept_tokens"] == sum(min(s, limit) for s in sizes)
        assert t["cut_documents"] == sum(s > limit for s in sizes)
