"""Token counts of the sections of a document, without encoding a section by itself.

A document is encoded once, as a whole, so its counts add up to what a model will see.
Byte-level tokens know their length, so a running sum gives every token its span of
bytes, and a count of lead bytes turns spans into characters. Sections are joined to
these intervals by binary search. A token that crosses a border goes by ``rule``:

* ``most``: to the section that holds most of its bytes, the earlier one if equal,
* ``first`` / ``last``: to the section of its first / last byte,
* ``share``: to each section by its share of the bytes (counts are then fractions).

Sections are the lines of the text with their line ends, or what the caller gives in
a column ``sections`` (disjoint character spans, in order). Tokens outside
all sections are counted under section -1, so the sum is always the document's count.

Cases: null and empty texts give one row, section 0 with no characters and no tokens (with given
sections, one row for each of those). A null ``sections`` stands for none. Rows with equal or no
doc_id are counted each. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.words import slices

RULES = ("most", "first", "last", "share")
_encodings: dict[str, tuple] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoding(path: str):
    """The tokenizer of a rank file, and the bytes of each token."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = [len(t) for t in ranks]
        own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encodings[path] = own, sizes
    return _encodings[path]


def allocate(token_ends: np.ndarray, borders: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section; sections lie between neighbouring ``borders`` (byte offsets) and cover the text."""
    n = len(borders) - 1
    starts = np.r_[0, token_ends[:-1]]
    first = np.searchsorted(borders, starts, side="right") - 1
    last = np.searchsorted(borders, token_ends, side="left") - 1
    if rule == "first":
        return np.bincount(first, minlength=n).astype(float)
    if rule == "last":
        return np.bincount(last, minlength=n).astype(float)
    counts = np.bincount(first[first == last], minlength=n).astype(float)
    for i in np.flatnonzero(first != last):  # only tokens on a border
        at = np.arange(first[i], last[i] + 1)
        held = np.minimum(borders[at + 1], token_ends[i]) - np.maximum(borders[at], starts[i])
        if rule == "share":
            counts[at] += held / held.sum()
        else:
            counts[at[np.argmax(held)]] += 1
    return counts


def _count(path: str, rule: str, given: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sizes = encoding(path)
        for batch in slices(batches):
            out: list[tuple] = []
            texts = batch.column("text").to_pylist()
            sections = batch.column("sections").to_pylist() if given else [None] * len(texts)
            for doc, text, spans in zip(batch.column("doc_id").to_pylist(), texts, sections, strict=True):
                text = text or ""
                data = np.frombuffer(text.encode(), np.uint8)
                ends = np.cumsum(sizes[own.encode_ordinary(text)]) if text else np.zeros(0, np.int64)
                leads = np.flatnonzero((data & 0xC0) != 0x80)
                at = np.r_[leads, len(data)]  # byte offset of each character
                if given:
                    spans = [(s["start"], s["end"]) for s in spans or []]
                    points, names = [0], []
                    for k, (a, b) in enumerate(spans):
                        a, b = min(a, len(leads)), min(b, len(leads))
                        points += [a, b]
                        names += [-1, k]
                    points.append(len(leads))
                    names.append(-1)
                    borders = at[np.array(points)]
                else:
                    lines = np.flatnonzero(data == 10) + 1
                    borders = np.unique(np.r_[0, lines, len(data)])
                    if len(borders) == 1:
                        borders = np.r_[borders, borders]
                    names = range(len(borders) - 1)
                    points = np.searchsorted(at, borders)
                full = np.flatnonzero(np.diff(borders))
                counts = np.zeros(len(borders) - 1)
                if len(full):
                    counts[full] = allocate(ends, np.r_[borders[full], borders[-1]], rule)
                outside = 0.0
                for k, name in enumerate(names):
                    if name < 0:
                        outside += counts[k]
                    else:
                        out.append((doc, name, int(points[k]), int(points[k + 1] - points[k]), counts[k], len(ends)))
                if given and outside:
                    out.append((doc, -1, None, None, outside, len(ends)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "section", "start_char", "n_chars", "n_tokens", "doc_tokens"],
            )

    return run


def section_tokens(docs: DataFrame, ranks: str, rule: str = "most") -> DataFrame:
    """Per document and section: start_char, n_chars, n_tokens, and the document's doc_tokens.

    ``docs`` may bring ``sections`` (array of struct start, end in characters).
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    given = "sections" in docs.columns
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    columns += [F.col("sections").cast("array<struct<start:long,end:long>>").alias("sections")] if given else []
    return docs.select(*columns).mapInArrow(
        _count(ranks, rule, given),
        "doc_id long, section long, start_char long, n_chars long, n_tokens double, doc_tokens long",
    )
