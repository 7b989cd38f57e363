"""Manifest and proofs against a version in plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

from llm_helpers import LOWER, SCHEMA

from orderloom.llm.merkle_manifest import FAN_BITS, fold, leaf_hash, manifest, proof_digest
from orderloom.llm.queries import QUERIES

FAN = 1 << FAN_BITS


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars) -> str:
    values = (doc_id, source, lang, n_chars, text)
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _up(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node what stands left and right of its path."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, covers = [], []
        for i in range(0, len(nodes), FAN):
            run = nodes[i : i + FAN]
            for k in range(len(run)):
                for leaf in under[i + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(_h("".join(run)))
            covers.append([leaf for u in under[i : i + FAN] for leaf in u])
        nodes, under = upper, covers
    return nodes[0], paths


def _expected(rows) -> list[tuple]:
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, _leaf(*r), r))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    tops = []
    for t in names:
        trees[t].sort(key=lambda x: x[:3])
        tops.append(_up([x[2] for x in trees[t]]))
    root, outer = _up([top for top, _ in tops])
    out = []
    for t, (subroot, paths), above in zip(names, tops, outer, strict=True):
        for (_, _, leaf, r), path in zip(trees[t], paths, strict=True):
            doc_id, text = r[0], r[1]
            now = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                now = _leaf(doc_id, text if text is None else text.translate(LOWER), *r[2:])
            proof = ""
            for left, right in path + above:
                now, proof = _h(left + now + right), proof + left + right
            out.append((doc_id, leaf, subroot, root, _h(proof), now, now == root))
    return sorted(out, key=repr)


def _query_of(df, block_levels):
    from string import ascii_lowercase, ascii_uppercase

    from pyspark.sql import functions as F

    low = F.translate("text", ascii_uppercase, ascii_lowercase)
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_hash({"text": low}))
    proved = manifest(df, {"altered": altered}, block_levels)
    folded = fold(F.coalesce("altered", "leaf"))
    return proved.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("p"), folded.alias("f"), (folded == F.col("root")).alias("v"))


def _rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows_in_two_tiers(odd, odd_rows):
    # A block of one level makes every language and the languages themselves span several tiers.
    assert _rows(_query_of(odd, 1)) == _expected(odd_rows)


def test_heights_at_the_edges_of_blocks_equal_rows_and_many_languages(spark):
    rows = [(i // 3, f"Text {i % 2}", f"{n}é", None, None) for n in (1, 2, 7, 8, 9, 63, 64, 65, 150) for i in range(n)]
    rows += [(i, "Same", None, "s", 4) for i in range(5)]
    assert _rows(_query_of(spark.createDataFrame(rows, SCHEMA), 2)) == _expected(rows)


def test_one_leaf_is_subroot_and_root(spark):
    rows = [(3, "Abc", "en", None, None)]
    found = _rows(_query_of(spark.createDataFrame(rows, SCHEMA), 4))
    assert found == _expected(rows) and found[0][1] == found[0][2] == found[0][3] and found[0][4] == _h("")


def test_empty_table(empty):
    assert _query_of(empty, 4).count() == 0


def test_query(spark, sf_dir):
    found = QUERIES["op11_merkle_manifest"](spark, sf_dir)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert _rows(found) == _expected(rows)
