"""Token ids of whole texts from a public tokenizer that drops white space.

Such a tokenizer never joins characters across white space, so a text's ids are
the ids of its words, one after another. Every different word of a batch is
encoded once; a worker keeps the ids of words between batches.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderloom.llm.batches import SPACED, Texts

#: Stems whose ids a task keeps at least, of which it forgets the longest unused; words encoded at once.
KEPT_STEMS, _AT_ONCE = 200_000, 20_000
#: Words of Latin letters (composed, with one lower-case letter each) and ASCII signs after them.
_SIMPLE = "^(?P<stem>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+)(?P<signs>[!-&(-/:-@\\[-`{-~]*)$"
_PROBES = ("Whether", "whether", "THE", "probe,", "It.", "a", "Zx!", "overwhelmingly;", "end|", "Écrit", "ñandú,", "GRÖSSE", "ŽLUŤ.", "x%%%", "n$-_]")

_WORKER: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of words by one tokenizer, as bytes of unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        # The model and its alphabet of bytes, without the steps that find nothing to do in simple words.
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.has_simple = True
        self.has_simple = self.encode([p.encode() for p in _PROBES]) == self._encode(self.full, _PROBES)

    def _encode(self, tokenizer, words: Sequence[str]) -> list[bytes]:
        out = []
        for i in range(0, len(words), _AT_ONCE):
            some = tokenizer.encode_batch_fast(words[i : i + _AT_ONCE], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in some]
        return out

    def _stems(self, stems: Sequence[str]) -> list[bytes]:
        """Ids of lower-cased letters, remembered between the batches of a task."""
        kept, older = self.kept, self.older
        if len(kept) > KEPT_STEMS:
            self.kept, self.older = kept, older = {}, kept
        new = []
        for stem in stems:
            if stem not in kept:
                if stem in older:
                    kept[stem] = older[stem]
                else:
                    new.append(stem)
        kept.update(zip(new, self._encode(self.bare, new), strict=True))
        return [kept[stem] for stem in stems]

    def pieces(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of different pieces of words, and the two pieces of each word.

        A simple word is its lower-cased letters and the signs after them; any
        other one is a piece, and an empty one after it.
        """
        text = words.cast(pa.large_string())
        if self.has_simple:
            parts = pc.extract_regex(text, _SIMPLE)
            simple = parts.is_valid()
        else:
            simple = pa.array(np.zeros(len(text), bool))
        other = text.filter(pc.invert(simple)).to_pylist()
        ids = [b"", *self._encode(self.full, other)]
        of_word = np.zeros((len(text), 2), np.int64)
        is_simple = simple.to_numpy(zero_copy_only=False)
        of_word[~is_simple, 0] = np.arange(1, len(ids))
        if is_simple.any():
            stem, signs = parts.filter(simple).flatten()
            for k, (column, encode) in enumerate(
                ((pc.utf8_lower(stem), self._stems), (signs, lambda some: self._encode(self.full, some)))
            ):
                found = column.dictionary_encode()
                of_word[is_simple, k] = found.indices.to_numpy() + len(ids)
                ids += encode(found.dictionary.to_pylist())
        return ids, of_word

    def encode(self, words: Sequence[bytes]) -> list[bytes]:
        ids, of_word = self.pieces(pa.array(words, pa.large_binary()))
        return [ids[a] + ids[b] for a, b in of_word.tolist()]


def encode(texts: Texts, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and where each text's begin (one more at the end)."""
    if path not in _WORKER:
        _WORKER[path] = WordEncoder(path)
    words = texts.words(SPACED)
    ids, of_word = _WORKER[path].pieces(words.distinct_array)
    flat = np.frombuffer(b"".join(ids), np.uint32)
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    first = np.cumsum(size) - size
    piece = of_word[words.codes].ravel()
    n = size[piece]
    total = np.concatenate([[0], np.cumsum(n)])
    origin = np.repeat(first[piece] - total[:-1], n)
    return flat[origin + np.arange(total[-1])], total[2 * words.at]


def forget() -> None:
    """Leave out the remembered stems, at the end of a task; tokenizers stay loaded."""
    for encoder in _WORKER.values():
        encoder.kept, encoder.older = {}, {}


def lengths(texts: Texts, path: str) -> np.ndarray:
    ids, at = encode(texts, path)
    return np.diff(at)
