"""Every stage on what the stage before kept, against brute force."""

from __future__ import annotations

from collections import Counter

import pytest
from llm_helpers import SPACED
from test_decontamination import expected as contaminated
from test_jaccard_join import components
from test_token_codes import expected as encoded

import corpus_pipeline
from orderloom.llm import quality_crf
from orderloom.llm.queries import held_out, table

STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows that went into each stage, and what came out of the last."""
    folder, docs, seen = tmp_path_factory.mktemp("stages"), table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = rows_of(docs)
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return seen, [tuple(r) for r in docs.collect()]


def test_quality_drops_what_the_classifier_rejects(spark, sf_dir, stages):
    seen, _ = stages
    documents = table(spark, sf_dir, "documents")
    model = quality_crf.fit(documents, table(spark, sf_dir, "labels"), ~held_out(4))
    good = {r["doc_id"] for r in quality_crf.rate(documents, model).where("predicted = 1").collect()}
    assert Counter(seen["near_duplicates"]) == Counter(r for r in seen["quality"] if r[0] in good)
    assert 0 < len(seen["near_duplicates"]) < len(seen["quality"])


def test_one_document_of_each_group_stays(stages):
    seen, _ = stages
    rows = seen["near_duplicates"]
    _, group = components(rows)
    first = {}
    for g, r in zip(group, rows, strict=True):
        first[g] = min(first.get(g, r), r)
    assert Counter(seen["decontamination"]) == Counter(first.values())


def test_contaminated_documents_go(spark, sf_dir, stages):
    seen, _ = stages
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    clean = {r[0] for r in contaminated(seen["decontamination"], items) if not r[4]}
    assert Counter(seen["mixing"]) == Counter(r for r in seen["decontamination"] if r[0] in clean)


def test_mixture_repeats_whole_documents(stages):
    seen, _ = stages
    before, after = Counter(seen["mixing"]), Counter(seen["token_ids"])
    assert set(after) <= set(before)
    assert max(after.values()) <= 2
    words = lambda rows: sum(len(SPACED.findall(r[1] or "")) * n for r, n in rows.items())
    assert words(after) == pytest.approx(1.5 * words(before), rel=0.1)


def test_files_hold_the_ids_of_all_that_is_left(stages):
    seen, out = stages
    assert sorted(out, key=lambda r: r[1]) == encoded(seen["token_ids"])


def test_odd_rows_and_empty_tables_pass_all_stages(spark, sf_dir, odd, empty):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            if name != "token_ids":
                assert docs.columns == columns
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        docs.collect()
