"""Packing of documents into sequences of a fixed length: bounded-space best-fit.

1. Whole documents are encoded (a word-level memory spares the tokenizer what it has
   seen; words go to it in bulk). Documents longer than a sequence are cut into full
   pieces and a rest. From here on only lengths travel, some 50 bytes a piece.
2. Pieces are dealt evenly over partitions. Each partition packs its stream as it comes, one run of at
   most ``RUN`` pieces after the other, with ``OPEN_BINS`` open sequences at most. Within a run longer pieces go first. A bitset keyed
   by free space finds the tightest open sequence that takes the piece; when another
   one has to be opened beyond the bound, the fullest is closed. There are more open sequences than pieces in a run, so long pieces do
   not close sequences before the short ones of their run have filled them.

A partition wastes about one sequence, so there are as many as keep ``PIECES_PER_TASK``
pieces in each. Memory is bounded by the open sequences, not by the number of pieces.

Every document ends with a separator id. Cases: null and empty texts are that
separator alone. Rows with equal doc_id are packed each. An empty table gives no rows. Ties take the sequence opened last.
Other columns are not read.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.words import slices
from shelfline.sources.workspace import new_run_root, stored

SEQUENCE = 2048
OPEN_BINS = 8192
RUN = 8192
PIECES_PER_TASK = 100_000
#: Words that a worker remembers in each of two generations; when the younger one is full, the older one is forgotten.
WORDS_KNOWN = 400_000
SEPARATOR = 0

_encoders: dict[str, "WordMemory"] = {}


class _Known(dict):
    """Ids of chunks of text; a word with a full stop or comma behind it is put together, not stored."""

    def __missing__(self, chunk: bytes) -> bytes:
        return self[chunk[:-1]] + self[chunk[-1:]]


class WordMemory:
    """Token ids of whole texts, equal to the tokenizer's own, for vocabularies that never cross white space.

    Ids are kept as two bytes each. A run of letters ends in a token that is marked as a
    word end, so many unknown words are encoded as one text and cut apart again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(1 << 16, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = _Known()
        self.older: dict[bytes, bytes] = {}
        self.marks = self.direct("."), self.direct(",")

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()

    def learn(self, chunks: set[bytes]) -> None:
        """See that every chunk is known, or is a known word with a known mark behind it."""
        if len(self.known) > WORDS_KNOWN:  # what is still in use comes back from the older generation
            self.known, self.older = _Known(), self.known
        known, older = self.known, self.older
        known[b"."], known[b","] = self.marks
        words, others = set(), []
        for chunk in chunks.difference(known):
            word = chunk[:-1] if chunk[-1] in b".," else chunk
            if chunk in older:
                known[chunk] = older[chunk]
            elif not word.decode().isalpha():
                others.append(chunk)
            elif word in older:
                known[word] = older[word]
            elif word not in known:
                words.add(word)
        self.learn_words(list(words))
        known.update((c, self.direct(c.decode())) for c in others)

    def learn_words(self, words: list[bytes]) -> None:
        """Runs of letters."""
        for at in range(0, len(words), 5000):
            part = words[at : at + 5000]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, np.uint16)
            ends = (np.flatnonzero(self.is_end[ids]) + 1).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                self.known.update(
                    (w, raw[2 * a : 2 * b]) for w, a, b in zip(part, [0, *ends[:-1]], ends, strict=True)
                )
            else:
                self.known.update((w, self.direct(w.decode())) for w in part)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split: list[list[bytes] | None] = []
        for text in texts:
            text = text or ""
            if "<|" in text or "Σ" in text or "İ" in text:
                split.append(None)  # special tokens, and letters whose lower case is no matter of one letter
                continue
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            # bytes are parted at ASCII white space only; any other stays within and is the tokenizer's
            split.append(text.lower().encode().split())
        self.learn(set().union(*(s for s in split if s)))
        get = self.known.__getitem__
        return [self.direct(t or "") if s is None else b"".join(map(get, s)) for t, s in zip(texts, split, strict=True)]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> WordMemory:
    if path not in _encoders:
        _encoders[path] = WordMemory(path)
    return _encoders[path]


def _pieces(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = encoder(path)
        for batch in slices(batches, most=1 << 21):
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc, code in zip(ids, memory.encode(batch.column("text").to_pylist()), strict=True):
                tokens = np.frombuffer(code, np.uint16).astype("<u4")
                tokens = np.append(tokens, np.uint32(SEPARATOR))
                for piece, start in enumerate(range(0, len(tokens), length)):
                    part = tokens[start : start + length]
                    rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _pack(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        packer = Packer(length)
        for frame in frames:
            frame["sequence_id"], frame["offset"] = packer.add_runs(frame["length"].to_numpy())
            frame["sequence_id"] += np.int64(part) << 40
            yield frame

    return run


class Packer:
    """Best-fit over a stream of lengths that comes in parts: sequence number and offset of each."""

    def __init__(self, size: int = SEQUENCE, most_open: int = OPEN_BINS):
        self.size, self.most_open = size, most_open
        self.bins: dict[int, list[int]] = defaultdict(list)
        self.free_set = self.n_open = self.made = 0

    def _take(self, free: int) -> int:
        own = self.bins[free].pop()
        if not self.bins[free]:
            self.free_set &= ~(1 << free)
        self.n_open -= 1
        return own

    def add_runs(self, lengths: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`add`, with the longer pieces of each run first."""
        places, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for begin in range(0, len(lengths), run):
            order = begin + np.argsort(-lengths[begin : begin + run], kind="stable")
            places[order], offsets[order] = self.add(lengths[order])
        return places, offsets

    def add(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.empty(len(lengths), np.int64)
        offsets = np.empty(len(lengths), np.int64)
        for i, need in enumerate(lengths.tolist()):
            above = self.free_set >> need
            if above:
                free = need + (above & -above).bit_length() - 1
                own = self._take(free)
            else:
                if self.n_open == self.most_open:
                    self._take((self.free_set & -self.free_set).bit_length() - 1)
                free, own = self.size, self.made
                self.made += 1
            places[i], offsets[i] = own, self.size - free
            if free > need:
                self.bins[free - need].append(own)
                self.free_set |= 1 << (free - need)
                self.n_open += 1
        return places, offsets


def packed(spark: SparkSession, docs: DataFrame, tokenizer: str, length: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    root = new_run_root(spark, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(
        spark,
        docs.mapInArrow(_pieces(tokenizer, length), "doc_id long, piece int, start long, length long, ids_crc32 long"),
        root,
        "pieces",
    )
    tasks = max(1, pieces.count() // PIECES_PER_TASK)
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece") % 65536).sortWithinPartitions("doc_id", "piece")
    return dealt.mapInPandas(
        _pack(length),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
