"""Alignment of two tokenizers' tokens over the same bytes, by divide and conquer at shared cuts.

1. Each text is encoded whole by both tokenizers: A is a byte-level BPE and gets a space in front,
   B is a SentencePiece model that puts one there itself. Tokens become byte ranges.
2. An interval of a text, the whole of it first, is divided at a place where a token of A and
   one of B end together: the ends of A are tried from the middle outwards, each looked up
   among the ends of B by bisection. Both halves are divided in the same way. An interval without
   such a place is a leaf, and its tokens are a group. All intervals of a chunk of
   documents take a step together in numpy; one that found no cut in ``STEPS`` steps has
   all its ends looked up at once.
3. The links of a group are all its pairs of a token of A and one of B. Per chunk of some
   ``CHUNK_BYTES`` of text, distinct id pairs and the number of documents that hold them are
   exploded, added up over the corpus, and handed back to the chunks that hold them. So what
   is shuffled are the different pairs of a chunk, not those of its documents, and nothing
   that grows with the corpus goes to every task: only the highest count of each A id does, one row for each of at
   most 65,536 ids.
4. Documents keep their pairs as places in the list of their chunk, so the counts are a gather.

Cases: texts that are null or empty, or whose tokens do not give the bytes back, have no tokens and
zeros in all columns. Strings of special tokens are plain text. Each row is a document of its own, also where rows are repeated or
have no doc_id. An empty table gives no rows. Other columns are not read. A group with many tokens is
expanded by its different ids, so a run of one letter costs no more than its length.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.words import slices
from shelfline.sources.workspace import new_run_root, stored

#: Text of a chunk; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 21
#: Places that an interval tries one by one, from its middle outwards.
STEPS = 12
#: Unknown words that are encoded as one text.
WORDS_TOGETHER = 200
#: Words whose ids a worker remembers before it forgets those that were not used lately.
WORDS_KNOWN = 200_000
#: Groups with more links than this are expanded by their different ids.
MANY_LINKS = 256

_tokenizers: dict[tuple[str, str], "Pair"] = {}


def default_a() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_b() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable bytes stand for themselves, the others follow from U+0100 on in their order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as handle:
            vocabulary = json.load(handle)["model"]["vocab"]
        alphabet = byte_alphabet()
        # ids follow the order of merges, so the vocabulary is its own table of ranks; added tokens are plain text here
        ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items() if all(c in alphabet for c in t)}
        added = {i: t.encode() for t, i in vocabulary.items() if not all(c in alphabet for c in t)}
        ranks = {t: i for t, i in ranks.items() if t != b"<|endoftext|>"}
        self.a = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = {i: t for t, i in ranks.items()} | added
        self.bytes_b = {
            i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.vocab_size()))
        }
        self.sizes_a, self.sizes_b = (_sizes(x) for x in (self.bytes_a, self.bytes_b))
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.vocab_size())):
            raise ValueError("B has a piece that goes on behind a mark")
        self.begins_word = np.array([self.b.id_to_piece(i).startswith("▁") for i in range(self.b.vocab_size())])
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.mark = np.array([self.b.piece_to_id("▁")], np.uint16).tobytes()
        # a token as text with the mark behind it: , | or ;
        most = max(len(self.sizes_a), len(self.sizes_b))
        self.written = [f"{i}{mark}".encode() for i in range(most) for mark in ",|;"]

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of B. No piece goes on behind its first mark, so words are encoded by themselves, unknown ones only."""
        split = [self.words_of(t) for t in texts]
        if len(self.known) > WORDS_KNOWN:  # what was not used since the last time goes
            self.known, self.earlier = {}, self.known
        known, earlier = self.known, self.earlier
        unknown = []
        for word in set().union(*split).difference(known):
            ids = earlier.get(word)
            if ids is None:
                unknown.append(word)
            else:
                known[word] = ids
        plain = [w for w in unknown if w and w[0] != " "]
        groups = [plain[i : i + WORDS_TOGETHER] for i in range(0, len(plain), WORDS_TOGETHER)]
        for words, ids in zip(groups, self.b.encode([" ".join(w) for w in groups], out_type=int, num_threads=1), strict=True):
            ids = np.array(ids, np.uint16)
            begins = np.flatnonzero(self.begins_word[ids])
            if len(begins) == len(words):  # else a word holds a mark of its own
                raw, at = ids.tobytes(), (2 * begins).tolist()
                known.update((w, raw[x:y]) for w, x, y in zip(words, at, [*at[1:], len(raw)], strict=True))
        rest = [w for w in unknown if w not in known]
        for word, ids in zip(rest, self.b.encode(rest, out_type=int, num_threads=1), strict=True):
            known[word] = np.array(ids, np.uint16).tobytes()
        known[""] = self.mark
        return [np.frombuffer(b"".join(map(known.__getitem__, s)), np.uint16).astype(np.int64) for s in split]

    @staticmethod
    def words_of(text: str) -> list[str]:
        """Words with all but the first of the spaces before them; B puts that one there itself."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, spaces = [], 0
        for w in words[:-1]:
            if w:
                out.append(" " * spaces + w)
                spaces = 0
            else:
                spaces += 1
        return [*out, " " * spaces + words[-1]]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B for every text; none for texts that the tokens do not give back."""
        none = np.zeros(0, np.int64)
        in_a, in_b = [none] * len(texts), [none] * len(texts)
        filled = [i for i, t in enumerate(texts) if t]
        for i, b in zip(filled, self.encode_b([texts[i] for i in filled]), strict=True):
            whole = " " + texts[i]
            a = np.array(self.a.encode_ordinary(whole), np.int64)
            raw = whole.encode()
            # A has a token for every byte and no normaliser, so its tokens can only be a cut of these bytes
            if self.sizes_a[a].sum() == len(raw) and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == raw:
                in_a[i], in_b[i] = a, b
        return in_a, in_b


def _sizes(tokens: dict[int, bytes]) -> np.ndarray:
    sizes = np.zeros(max(tokens) + 1, np.int64)
    sizes[list(tokens)] = [len(t) for t in tokens.values()]
    return sizes


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _tokenizers:
        _tokenizers[path_a, path_b] = Pair(path_a, path_b)
    return _tokenizers[path_a, path_b]


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which tokens of A end where one of B ends.

    Ends grow over all documents; document i has the tokens first[i] to first[i + 1] of A, and
    its last ones end together.
    """
    cut = np.zeros(len(ends_a), bool)
    low, high = first[:-1], first[1:]
    low, high = low[high > low], high[high > low]
    cut[high - 1] = True

    def common(places: np.ndarray) -> np.ndarray:
        ends = ends_a[places]
        return ends_b[np.searchsorted(ends_b, ends)] == ends

    step = np.zeros(len(low), np.int64)
    # intervals stay in their order, so that the look-ups run through the ends of B once
    while True:
        inner = high - low - 1  # ends inside the interval
        some = inner > step
        low, high, step, inner = low[some], high[some], step[some], inner[some]
        if not len(low):
            return cut
        late = step >= STEPS
        if late.any():  # look up what is left of these at once
            sizes = inner[late]
            places = np.repeat(low[late] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            cut[places[common(places)]] = True
            low, high, step, inner = low[~late], high[~late], step[~late], inner[~late]
        # the middle, one to its right, one to its left, two to its right ...
        tried = low + (inner - 1) // 2 + np.where(step % 2, (step + 1) // 2, -(step // 2))
        hit = common(tried)
        at = tried[hit]
        cut[at] = True
        place = np.cumsum(1 + hit) - 1 - hit
        low, high, step = (np.repeat(x, 1 + hit) for x in (low, high, step + 1))
        left = place[hit]
        high[left] = low[left + 1] = at + 1
        step[left] = step[left + 1] = 0


class Groups:
    """Groups of several documents: tokens of A and B, and where each group and each document begins."""

    def __init__(self, own: Pair, in_a: list[np.ndarray], in_b: list[np.ndarray]):
        self.own = own
        self.a, self.b = np.concatenate(in_a), np.concatenate(in_b)
        self.first_a = np.r_[0, np.cumsum([len(x) for x in in_a])]
        self.first_b = np.r_[0, np.cumsum([len(x) for x in in_b])]
        ends_a, ends_b = np.cumsum(own.sizes_a[self.a]), np.cumsum(own.sizes_b[self.b])
        last_a = np.flatnonzero(shared_cuts(ends_a, ends_b, self.first_a))
        last_b = np.searchsorted(ends_b, ends_a[last_a])
        self.begin_a, self.begin_b = np.r_[0, last_a + 1], np.r_[0, last_b + 1]
        self.n_a, self.n_b = np.diff(self.begin_a), np.diff(self.begin_b)
        #: groups of document i: first[i] to first[i + 1]
        self.first = np.searchsorted(self.begin_a[:-1], self.first_a)
        self.owner = np.repeat(np.arange(len(in_a)), np.diff(self.first))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, id pair) in order, and how often each is linked; a pair is a << 16 | b."""
        sizes = self.n_a * self.n_b
        usual = np.flatnonzero(sizes <= MANY_LINKS)
        n = sizes[usual]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat(self.n_b[usual], n)
        a = self.a[np.repeat(self.begin_a[usual], n) + within // wide]
        b = self.b[np.repeat(self.begin_b[usual], n) + within % wide]
        keys, counts = np.unique(np.repeat(self.owner[usual], n) << 32 | a << 16 | b, return_counts=True)
        for g in np.flatnonzero(sizes > MANY_LINKS):
            a, times_a = np.unique(self.a[self.begin_a[g] : self.begin_a[g + 1]], return_counts=True)
            b, times_b = np.unique(self.b[self.begin_b[g] : self.begin_b[g + 1]], return_counts=True)
            more = (self.owner[g] << 32 | a[:, None] << 16 | b[None]).ravel()
            keys, at = np.unique(np.r_[keys, more], return_inverse=True)
            counts = np.bincount(at, np.r_[counts, np.outer(times_a, times_b).ravel()]).astype(np.int64)
        return keys >> 32, keys & 0xFFFFFFFF, counts

    def written(self) -> list[bytes]:
        """Groups of each document as text: ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = (np.repeat(np.arange(len(n)), n) for n in (self.n_a, self.n_b))
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[self.begin_a[1:] - 1] = 1
        mark_b[self.begin_b[1:] - 1] = 2
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        # tokens of A stand behind those of B of earlier groups, those of B behind those of A of their own group
        codes[np.arange(len(self.a)) + self.begin_b[group_a]] = self.a * 3 + mark_a
        codes[np.arange(len(self.b)) + self.begin_a[group_b + 1]] = self.b * 3 + mark_b
        ends = self.first_a + self.first_b
        table = self.own.written
        return [b"".join(map(table.__getitem__, codes[x:y].tolist()))[:-1] for x, y in zip(ends[:-1], ends[1:], strict=True)]


def aligned_groups(own: Pair, text: str | None) -> list[tuple[list[int], list[int]]]:
    """Groups of one text as lists of ids."""
    in_a, in_b = own.encode([text])
    if not len(in_a[0]):
        return []
    g = Groups(own, in_a, in_b)
    return [
        (g.a[w:x].tolist(), g.b[y:z].tolist())
        for w, x, y, z in zip(g.begin_a[:-1], g.begin_a[1:], g.begin_b[:-1], g.begin_b[1:], strict=True)
    ]


_ROWS = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("is_document", T.BooleanType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("places", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("documents", T.ArrayType(T.LongType())),
    ]
)


def pack_places(places: np.ndarray) -> bytes:
    """Rising numbers as their gaps, two bytes each where they fit."""
    gaps = np.diff(places, prepend=0)
    wide = bool(len(gaps)) and int(gaps.max()) > 0xFFFF
    return bytes([wide]) + gaps.astype(np.uint32 if wide else np.uint16).tobytes()


def unpack_places(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint32 if raw[0] else np.uint16, offset=1).astype(np.int64))


def pack_times(times: np.ndarray) -> bytes:
    """Counts that are mostly 1: which are not, and these."""
    several = np.flatnonzero(times > 1)
    return np.concatenate([several, times[several]]).astype(np.uint32).tobytes()


def unpack_times(raw: bytes, n: int) -> np.ndarray:
    times = np.ones(n, np.int64)
    several = np.frombuffer(raw, np.uint32).reshape(2, -1)
    times[several[0]] = several[1]
    return times


def _align(path_a: str, path_b: str):
    names = [f.name for f in _ROWS]

    def chunk_rows(own: Pair, ids: list[int | None], texts: list[str | None], chunk: int) -> Iterator[pa.RecordBatch]:
        in_a, in_b = own.encode(texts)
        groups = Groups(own, in_a, in_b)
        owners, codes, times = groups.links()
        pairs, places, documents = np.unique(codes, return_inverse=True, return_counts=True)
        at = np.searchsorted(owners, np.arange(len(ids) + 1))
        links = np.bincount(groups.owner, groups.n_a * groups.n_b, minlength=len(ids)).astype(np.int64)
        shas = [hashlib.sha256(w).hexdigest() if w else "" for w in groups.written()]
        spans = list(zip(at[:-1], at[1:], strict=True))
        n = len(ids)
        columns = {
            "chunk": pa.array(np.full(n, chunk)),
            "is_document": pa.array(np.ones(n, bool)),
            "doc_id": pa.array(ids, pa.int64()),
            "n_a": pa.array(np.diff(groups.first_a)),
            "n_b": pa.array(np.diff(groups.first_b)),
            "n_groups": pa.array(np.diff(groups.first)),
            "n_links": pa.array(links),
            "groups_sha256": pa.array(shas, pa.string()),
            "places": pa.array([pack_places(places[x:y]) for x, y in spans], pa.binary()),
            "times": pa.array([pack_times(times[x:y]) for x, y in spans], pa.binary()),
            "pairs": pa.nulls(n, pa.list_(pa.int64())),
            "documents": pa.nulls(n, pa.list_(pa.int64())),
        }
        yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)
        row = {c: pa.nulls(1, columns[c].type) for c in names} | {
            "chunk": pa.array([chunk], pa.int64()),
            "is_document": pa.array([False]),
            "pairs": pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs)),
            "documents": pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(documents)),
        }
        yield pa.RecordBatch.from_arrays([row[c] for c in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(path_a, path_b)
        base = TaskContext.get().partitionId() << 32
        for chunk, batch in enumerate(slices(batches, most=CHUNK_BYTES)):
            yield from chunk_rows(own, batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), base + chunk)

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _look_up(rows: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
    """Documents of a chunk with the counts of its pairs."""
    facts = facts.sort_values("pair")
    counts = facts["count"].to_numpy(np.int64)
    best = counts == facts["highest"].to_numpy(np.int64)
    found = []
    for r in rows[["places", "times"]].itertuples(index=False):
        places = unpack_places(r.places)
        times = unpack_times(r.times, len(places))
        found.append((int(times[best[places]].sum()), int((times * counts[places]).sum())))
    out = rows.drop(columns=["chunk", "places", "times"])
    out["n_best"], out["count_sum"] = map(list, zip(*found, strict=True)) if found else ([], [])
    return out[["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]]


def alignment(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their counts, and the corpus-wide id pairs (a, b, documents, highest of a)."""
    root = new_run_root(spark, "alignment")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(spark, docs.mapInArrow(_align(path_a, path_b), _ROWS), root, "rows")
    of_chunks = rows.where("not is_document").select("chunk", F.explode(F.arrays_zip("pairs", "documents")).alias("x"))
    of_chunks = of_chunks.select("chunk", F.col("x.pairs").alias("pair"), F.col("x.documents").alias("documents"))
    counts = stored(spark, of_chunks.groupBy("pair").agg(F.sum("documents").alias("count")), root, "counts")
    # one row for each id of A, 65,536 at most
    highest = counts.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.max("count").alias("highest"))
    known = counts.withColumn("a", F.shiftright("pair", 16)).join(F.broadcast(highest), "a")
    facts = of_chunks.select(F.col("chunk").alias("of_chunk"), "pair").join(known.select("pair", "count", "highest"), "pair")
    documents = rows.where("is_document").select(
        "chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times"
    )
    found = documents.groupBy("chunk").cogroup(facts.groupBy("of_chunk")).applyInPandas(_look_up, _RESULT)
    pairs = known.select("a", F.col("pair").bitwiseAND(0xFFFF).alias("b"), F.col("count").alias("documents"), "highest")
    return found, pairs
