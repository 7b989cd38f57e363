"""Helpers of these tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(rng: random.Random, n: int, syllables=("tha", "on", "er", "ing", "st", "ou", "re", "é", "ß")) -> str:
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)]
    return "".join(w + rng.choice((" ", " ", " ", "  ", ".\n", ", ", "\t")) for w in words)
