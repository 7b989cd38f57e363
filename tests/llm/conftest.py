from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_helpers import SCHEMA, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(3)
    base = prose(rng, 120)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "en", "a", 6),
        (4, base, "en", "a", len(base)),
        (4, base, "en", "a", len(base)),
        (5, base.upper(), "en", "b", len(base)),
        (6, base + " more words here", "de", None, 9),
        (None, base, "de", "b", 9),
        (7, prose(rng, 30_000), "fr", "c", 1),
        (8, "x" * 200_000, None, "c", 1),
        (9, "\n" * 3000, "fr", "c", 1),
        (10, "one two", "fr", "é", 1),
        (11, "one two", "fr", "é", 1),
        (12, "12 34 !!", "fr", "é", 1),
        (13, "MIT License, mit\nlicense; General Public License", "en", "c", 1),
    ]
    rows += [(100 + i, prose(rng, rng.randint(1, 60)), rng.choice(("en", "de")), rng.choice("abc"), 1) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows, with further columns of names that operators use themselves."""
    more = "score double, size bigint, key string, target double, n_words bigint, `class` bigint, `last` string, copies int"
    return spark.createDataFrame([(*r, 0.5, 1, "k", 2.0, 3, None, "z", 7) for r in odd_rows], f"{SCHEMA}, {more}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
