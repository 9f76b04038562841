"""Dense statistics of texts, a row of numbers each, from the bytes and the word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfline.llm.words import Words, buffers, words_of

_CLASSES = ("upper", "lower", "digit", "blank", "newline", "stop", "comma", "mark", "pipe", "symbol", "other", "above")
_CLASS = np.full(256, _CLASSES.index("other"), np.int64)
for _name, _bytes in {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".",
    "comma": b",;:",
    "mark": b"!?",
    "pipe": b"|<>{}[]",
    "symbol": b"#*%$&@^~_=+\\",
    "above": range(128, 256),
}.items():
    _CLASS[list(_bytes)] = _CLASSES.index(_name)

STATS = (
    "log_words",
    *(f"share_{c}" for c in _CLASSES),
    "word_bytes",
    "distinct",
    "top_word",
    "same_as_before",
    "repeated_pairs",
    "repeated_triples",
    "starts_upper",
    "ends_letter",
    "ends_symbol",
    "all_upper_pairs",
    "words_per_line",
    "words_per_stop",
)


def _repeats(owners: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: values, distinct values, and how often the most frequent one occurs."""
    total = np.bincount(owners, minlength=n)
    distinct, top = np.zeros(n), np.zeros(n)
    if len(owners):
        order = np.lexsort((values, owners))
        o, v = owners[order], values[order]
        starts = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])])
        runs = np.diff(starts, append=len(o))
        distinct += np.bincount(o[starts], minlength=n)
        np.maximum.at(top, o[starts], runs)
    return total, distinct, top


def text_stats(texts: pa.Array, words: Words | None = None) -> np.ndarray:
    """One row per text, columns as in ``STATS``; an empty text has zeros."""
    words = words or words_of(texts, lower=True)
    n = len(words.offsets) - 1
    sizes = np.diff(words.offsets)
    owner_of_byte = np.repeat(np.arange(n), sizes)
    raw, _ = buffers(texts)
    by_class = np.bincount(owner_of_byte * len(_CLASSES) + _CLASS[raw], minlength=n * len(_CLASSES)).reshape(n, -1)
    owners = words.owner
    count, distinct, top = _repeats(owners, words.hashes, n)

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owners, weights=flags, minlength=n) / np.maximum(count, 1)

    same = np.zeros(len(owners))
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owners[1:] == owners[:-1])
    repeated = []
    for k in (2, 3):
        hashes, whole = words.grams(k)
        at = np.flatnonzero(whole)
        total, different, _ = _repeats(owners[at], hashes[at], n)
        repeated.append((total - different) / np.maximum(total, 1))
    first, last = _CLASS[raw[words.starts]], _CLASS[raw[words.ends - 1]]
    second = _CLASS[raw[np.minimum(words.starts + 1, words.ends - 1)]]
    is_upper = first == _CLASSES.index("upper")
    letters = (_CLASSES.index("upper"), _CLASSES.index("lower"), _CLASSES.index("above"), _CLASSES.index("digit"))
    bytes_in_words = np.bincount(owners, weights=words.ends - words.starts, minlength=n)
    return np.column_stack(
        [
            np.log1p(count),
            by_class / np.maximum(sizes, 1)[:, None],
            bytes_in_words / np.maximum(count, 1),
            distinct / np.maximum(count, 1),
            top / np.maximum(count, 1),
            per_word(same),
            *repeated,
            per_word(is_upper),
            per_word(np.isin(last, letters)),
            per_word(last == _CLASSES.index("symbol")),
            per_word(is_upper & (second == _CLASSES.index("upper"))),
            np.log1p(count / (by_class[:, _CLASSES.index("newline")] + 1)),
            np.log1p(count / (by_class[:, _CLASSES.index("stop")] + 1)),
        ]
    )
