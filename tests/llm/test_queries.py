"""The registered queries over whole tables: against SQL where there is some, else against brute force."""

from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from llm_helpers import ALNUM, LOWER
from test_license_and_mixing import expected_base
from test_models import check_language_model
from test_token_codes import PATH, expected, tokenizers

import __spark_entry__ as driver
from orderloom.llm.oracles import ORACLES
from orderloom.llm.queries import QUERIES

QUERY = driver.queries()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def rows(sql):
    return sql.execute("SELECT doc_id, text, lang, source, n_chars FROM documents").fetchall()


def held_out(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor == 2


def test_every_operator_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert {*QUERIES, "pipeline"} <= set(QUERY)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sql, sf_dir, name):
    found = QUERY[name](spark, sf_dir)
    result = sql.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(result.fetchall())


def test_language_id(spark, sf_dir, rows):
    langs = {r[0]: r[2] for r in rows}
    found = QUERY["op1_language_id"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(langs)
    assert all(r["held_out"] == held_out(r["doc_id"], 4) for r in found)
    unseen = [r for r in found if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in unseen]) > 0.85


def test_language_model(spark, sf_dir, rows):
    found = QUERY["op3_neural_lm"](spark, sf_dir)
    numbers = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check_language_model(rows, lambda i: not held_out(i, 7), found.select(*numbers).collect())


def test_length_histogram_and_token_ids(spark, sf_dir, rows):
    want = expected(rows)
    found = QUERY["op10_token_codes"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(want)
    histogram = {r["length"]: r["n_documents"] for r in QUERY["op4_length_histogram"](spark, sf_dir).collect()}
    lengths, counts = np.unique([n - 1 for _, _, n, _ in want], return_counts=True)
    assert histogram == dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    assert tokenizers.Tokenizer.from_file(PATH).get_vocab_size() > 0


def test_license_scan(spark, sf_dir, rows):
    found = QUERY["op6_license_scan"](spark, sf_dir)
    base = found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, base), key=str) == expected_base(rows)
    labels = {r["doc_id"]: r["labels"].split(",") for r in found.collect()}
    for doc_id, text, *_ in rows:
        joined = " ".join(ALNUM.findall((text or "").translate(LOWER)))
        assert ("cc-by-nc" in labels[doc_id]) == ("licensed under cc by nc 4 0" in joined)


def test_quality(spark, sf_dir, sql):
    labels = dict(sql.execute("SELECT doc_id, quality FROM labels").fetchall())
    found = QUERY["op8_quality_crf"](spark, sf_dir).collect()
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found)
    graded = [r for r in found if r["doc_id"] in labels and r["held_out"]]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in graded]) > 0.85
