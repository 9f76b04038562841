"""Repeated passages across documents, by a sparse suffix array over all texts.

1. Suffixes are kept only where the content selects them: a position is an anchor if
   the hash of its ``GRAM`` words is the smallest among ``WINDOW`` positions in a row
   (rightmost of equals). Equal passages select equal anchors.
2. All suffixes are sorted by the digest of their first ``SEED`` words, then by place,
   and neighbours are compared: a run of equal digests is one passage, and its first
   (doc_id, place) is the occurrence that stays.
3. Suffixes of one document that follow each other against the same occurrence make a
   match, which is then extended word by word to the left and to the right. Matches that
   touch are joined; stretches of at least ``min_words`` words are the result. Texts that go round
   in a few words have the same digest at many places, at equal steps: these are sorted as one row, and what they match travels together.
4. The first occurrence of 34 words need not hold 50 words of the passage that later
   ones share. So every other occurrence also gives the digests of all stretches of 50
   words around its anchors that run over a border of its match. They are sorted in the
   same way, and equal ones are repeats of their own first occurrence. Stretches inside
   a match are the first occurrence's own, and need no digest.

With these figures every passage of 50 words has an anchor in its first 16 words, and so
34 words to its right. ``doc_id`` order decides which occurrence stays; repeats
within one document are left alone.

Cases: null, empty and short texts have no anchors. Rows without doc_id are left alone.
Rows that share a doc_id are no repeats of each other; a row is named by its doc_id and a hash of its text, so each is compared, and
cut, by its own text. Words are told apart by
64-bit hashes of their bytes, white space between them is ignored. Other columns are
not read, and stay as they are in ``cut_repeats``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.sorted_runs import repeated
from shelfline.llm.words import Words, signed, slices, words_of
from shelfline.sources.workspace import new_run_root, stored

MIN_WORDS = 50
GRAM = 6
WINDOW = 16
SEED = 34
#: Words beside a match that can still belong to it: further out there would be another anchor.
REACH = WINDOW + GRAM
#: Places of a document that go in one row if the same occurrence matches them, as in runs of one word; further ones go in further rows.
PLACES = 64


def least_of_windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First positions of all windows, and the smallest of each, rightmost of equals; WINDOW is a power of two."""
    hashes, whole = words.grams(GRAM)
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << 20) - 1)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes & ~low) | (low - (places & low))
    step = 1
    while step < WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    begins = places[: len(least)]
    # the window's last gram must end in the document that holds its first word
    inside = whole[WINDOW - 1 :] & (words.owner[: len(least)] == words.owner[WINDOW - 1 : WINDOW - 1 + len(least)])
    begins, least = begins[inside], least[inside]
    return begins.astype(np.int64), (begins + (((low - (least & low)) - begins) & low)).astype(np.int64)


def anchors(words: Words) -> np.ndarray:
    """Word positions that are the smallest of some window."""
    return np.unique(least_of_windows(words)[1])


def _rows_of(places: np.ndarray, farthest: int, *equal: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of places with equal values that follow each other at equal steps, ``farthest`` at most, as in texts that go round
    in a few words: the first and the last of each row, the step, and the number of places."""
    order = np.lexsort((places, *equal))
    step = np.diff(places[order])
    apart = step > farthest
    for values in equal:
        apart |= values[order][1:] != values[order][:-1]
    new = np.r_[True, apart][: len(order)]
    new[2:] |= ~apart[:-1] & (step[1:] != step[:-1])
    first = np.flatnonzero(new)
    size = np.diff(first, append=len(order))
    steps = np.ones(len(first), np.int64)
    steps[size > 1] = step[first[size > 1]]
    return order[first], order[first + size - 1], steps, size


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words = words_of(batch.column("text"))
        digests, whole = words.spans(SEED)
        places = anchors(words)
        places = places[places < len(digests)]
        places = places[whole[places]]
        first, _, step, run = _rows_of(places, SEED, digests[places], words.owner[places])
        places = places[first]
        owner = words.owner[places]
        ids, tags = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[owner] for c in ("doc_id", "tag"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(digests[places])), pa.array(ids), pa.array(places - words.first[owner]), pa.array(tags), pa.array(step), pa.array(run)],
            names=["key", "doc_id", "place", "tag", "step", "run"],
        )


#: Kinds of rows that come from the texts.
MATCH, BESIDE, STRETCH = range(3)
_FOUND = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tag", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("places", T.ArrayType(T.LongType())),
        T.StructField("lead_doc", T.LongType()),
        T.StructField("lead_first", T.LongType()),
        T.StructField("lead_last", T.LongType()),
        T.StructField("left", T.BinaryType()),
        T.StructField("right", T.BinaryType()),
        T.StructField("char_starts", T.ArrayType(T.LongType())),
        T.StructField("char_ends", T.ArrayType(T.LongType())),
        T.StructField("key", T.LongType()),
        T.StructField("char_start", T.LongType()),
        T.StructField("char_end", T.LongType()),
        T.StructField("step", T.LongType()),
        T.StructField("run", T.LongType()),
    ]
)


def _beside(hashes: np.ndarray, firsts: np.ndarray, ends: np.ndarray, outside: int) -> list[list[bytes]]:
    """The REACH word hashes left of each first (nearest first) and right of each end; ``outside`` where the text ends."""
    found = []
    for at in (firsts[:, None] - 1 - np.arange(REACH), ends[:, None] + np.arange(REACH)):
        inside = (at >= 0) & (at < len(hashes))
        taken = np.where(inside, hashes[np.where(inside, at, 0)], np.uint32(outside)).astype(np.uint32)
        found.append([row.tobytes() for row in taken])
    return found


def _matches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """From documents with their hits: matches, stretches of ``size`` words over the borders of matches, and the words
    beside the occurrences that others were matched with."""
    names = [f.name for f in _FOUND]
    longs = pa.list_(pa.int64())
    kinds = (pa.int32(), *[pa.int64()] * 3, longs, *[pa.int64()] * 3, pa.binary(), pa.binary(), longs, longs, *[pa.int64()] * 5)
    for batch in slices(batches):
        words = words_of(batch.column("text"))
        short = (words.hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        before = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum((words.data & 0xC0) != 0x80, out=before[1:])
        windows, least = least_of_windows(words)
        digests, whole = words.spans(size)
        seeds, _ = words.spans(SEED)
        inside = windows < len(digests)
        inside[inside] = whole[windows[inside]]
        windows, least = windows[inside], least[inside]
        rows: list[tuple] = []
        stretches: list[np.ndarray] = []
        hits, wanted = batch.column("hits"), batch.column("wanted")
        for i, (doc, tag) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist(), strict=True)):
            own = short[words.first[i] : words.first[i + 1]]
            base = before[words.offsets[i]]
            starts = before[words.starts[words.first[i] : words.first[i + 1]]] - base
            ends = before[words.ends[words.first[i] : words.first[i + 1]]] - base
            h = np.zeros((0, 3), np.int64)
            if hits[i].is_valid:
                h = hits[i].values
                h = np.column_stack([h.field(c).to_numpy(zero_copy_only=False) for c in ("place", "lead_doc", "lead_place", "tag")])
                h = h[h[:, 3] == tag, :3]  # other rows of the id have hits of their own
            if len(h):
                h = h[np.lexsort((h[:, 0], h[:, 2] - h[:, 0], h[:, 1]))]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:, 1] != h[:-1, 1]) | (h[1:, 2] - h[1:, 0] != h[:-1, 2] - h[:-1, 0]) | (h[1:, 0] > h[:-1, 0] + SEED)
                first = np.flatnonzero(new)
                last = np.r_[first[1:], len(h)] - 1
                begin, end = h[first, 0], h[last, 0] + SEED
                # a match with an earlier place of the same document only bounds the stretches below
                other = np.flatnonzero(h[first, 1] != doc)
                leads = np.column_stack([h[first, 1], h[first, 2], h[last, 2]])[other]
                order = np.lexsort((begin[other], leads[:, 2], leads[:, 1], leads[:, 0]))
                other, leads = other[order], leads[order]
                groups = np.flatnonzero(np.r_[True, (leads[1:] != leads[:-1]).any(axis=1)]) if len(other) else []
                for of in (g[k : k + PLACES] for g in np.split(other, groups[1:]) for k in range(0, len(g), PLACES)):
                    b, e = begin[of], end[of]
                    left, right = _beside(own, b, e, 1)
                    beyond = np.arange(REACH + 1)  # behind the text's ends nothing is equal, so what stands there is never read
                    char_starts = starts[np.maximum(b[:, None] - beyond, 0)].ravel()
                    char_ends = ends[np.minimum(e[:, None] - 1 + beyond, len(ends) - 1)].ravel()
                    lead_doc, lead_first, lead_last = int(h[first[of[0]], 1]), int(h[first[of[0]], 2]), int(h[last[of[0]], 2])
                    rows.append((MATCH, doc, tag, None, b, lead_doc, lead_first, lead_last, b"".join(left), b"".join(right), char_starts, char_ends, *[None] * 5))
                own_windows = slice(*np.searchsorted(windows, words.first[i : i + 2]))
                at, anchor = windows[own_windows] - words.first[i], least[own_windows] - words.first[i]
                order = np.argsort(h[:, 0], kind="stable")
                hit = order[np.minimum(np.searchsorted(h[order, 0], anchor), len(h) - 1)]
                match = np.cumsum(new)[hit] - 1
                at = at[(h[hit, 0] == anchor) & ((at < begin[match]) | (at + size > end[match]))]
                keys = signed(digests[at + words.first[i]])
                one, to, step, run = _rows_of(at, size, keys)
                at, keys, to = at[one], keys[one], at[to]
                stretches.append(np.column_stack([np.full(len(at), doc), np.full(len(at), tag), at, keys, starts[at], ends[to + size - 1], step, run]))
            if wanted[i].is_valid:
                w = wanted[i].values
                at, keys = (w.field(c).to_numpy(zero_copy_only=False) for c in ("lead_place", "key"))
                # of the rows of an id, those that hold the words that were matched there
                at, keys = at[at + SEED <= len(own)], keys[at + SEED <= len(own)]
                at = np.unique(at[signed(seeds[at + words.first[i]]) == keys])
                left, right = _beside(own, at, at + SEED, 2)
                rows += [
                    (BESIDE, doc, tag, p, *[None] * 4, x, y, *[None] * 7) for p, x, y in zip(at.tolist(), left, right, strict=True)
                ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        if n := sum(map(len, stretches)):
            parts = np.ascontiguousarray(np.concatenate(stretches).T)
            columns = {"kind": np.full(n, STRETCH, np.int32)} | dict(zip(("doc_id", "tag", "place", "key", "char_start", "char_end", "step", "run"), parts, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, kinds, strict=True)], names=names
            )


#: Stretches of a document with the place that each repeats; those that come of one row travel in one row.
_SPANS = "array<struct<start: long, end: long, char_start: long, char_end: long, match_doc_id: long, match_start: long>>"


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def hashes(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, REACH)

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("places").value_lengths().to_numpy()
        of = np.repeat(np.arange(batch.num_rows), sizes)
        left, right = (
            np.cumprod(hashes(batch.column(side)) == hashes(batch.column(f"lead_{side}"))[of], axis=1).sum(axis=1) for side in ("left", "right")
        )
        lead_doc, lead_first, lead_last = (batch.column(c).to_numpy()[of] for c in ("lead_doc", "lead_first", "lead_last"))
        places, starts, ends = (batch.column(c).flatten().to_numpy() for c in ("places", "char_starts", "char_ends"))
        at = np.arange(len(of)) * (REACH + 1)
        columns = {
            "start": places - left,
            "end": places + lead_last - lead_first + SEED + right,
            "char_start": starts[at + left],
            "char_end": ends[at + right],
            "match_doc_id": lead_doc,
            "match_start": lead_first - left,
        }
        spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tag"), pa.ListArray.from_arrays(offsets, spans)], names=["doc_id", "tag", "spans"]
        )


def _touching(start: np.ndarray, end: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by ``keys``, start and end, and where in it each run of spans begins that have equal keys and overlap or touch."""
    order = np.lexsort((end, start, *keys[::-1]))
    others = np.zeros(len(order), bool)
    for key in keys:
        others[1:] |= key[order][1:] != key[order][:-1]
    # spans of later keys lie behind all of the earlier ones
    apart = np.cumsum(others) * (int(end.max()) + 2)
    reached = np.maximum.accumulate(end[order] + apart)
    return order, np.flatnonzero(np.r_[True, reached[:-1] < (start[order] + apart)[1:]])


def _stretches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """From documents with all their spans: the stretches that these make together, with the longest match in each."""
    for batch in batches:
        lists = batch.column("spans")
        spans = lists.flatten()
        if not len(spans):
            continue
        of = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        start, end, char_start, char_end, match, match_start = (spans.field(i).to_numpy(zero_copy_only=False) for i in range(6))
        # what overlaps and repeats the same place is one match
        order, first = _touching(start, end, of, match, match_start - start)
        of, match = of[order][first], match[order][first]
        start, char_start, match_start = (np.minimum.reduceat(c[order], first) for c in (start, char_start, match_start))
        end, char_end = (np.maximum.reduceat(c[order], first) for c in (end, char_end))
        order, first = _touching(start, end, of)
        stretch = np.empty(len(order), np.int64)
        stretch[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
        by_length = np.lexsort((-match_start, -match, end - start, stretch))
        longest = by_length[np.r_[first[1:], len(order)] - 1]
        begin, char_begin = (np.minimum.reduceat(c[order], first) for c in (start, char_start))
        n_words, n_chars = (np.maximum.reduceat(c[order], first) - b for c, b in ((end, begin), (char_end, char_begin)))
        doc_id, tag = (batch.column(c).to_numpy()[of[order][first]] for c in ("doc_id", "tag"))
        columns = {
            "doc_id": doc_id,
            "text_hash": tag,
            "start_word": begin,
            "n_words": n_words,
            "start_char": char_begin,
            "n_chars": n_chars,
            "match_doc_id": match[longest],
            "match_start_word": match_start[longest],
        }
        kept = pa.array(n_words >= min_words)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], names=list(columns)).filter(kept)


def repeated_passages(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stretches that an earlier document holds, too.

    doc_id, text_hash, start_word, n_words, start_char, n_chars, and of the longest match in it
    match_doc_id and match_start_word; ``text_hash`` is Spark's xxhash64 of the row's text. ``min_words`` may not be below 50.
    """
    if min_words < WINDOW - 1 + SEED:
        raise ValueError("passages this short need other anchors")
    size = min(min_words, MIN_WORDS)
    root = new_run_root(spark, "suffixes")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    suffixes = stored(spark, docs.mapInArrow(_suffixes, "key long, doc_id long, place long, tag long, step long, run long"), root, "suffixes")
    hits = stored(
        spark,
        repeated(suffixes, lambda x: stored(spark, x, root, "runs"), ("tag", "step", "run"))
        .selectExpr("key", "doc_id", "explode(sequence(place, place + step * (run - 1), step)) AS place", "tag", "lead_doc", "lead_place")
        .where("doc_id <> lead_doc or place <> lead_place"),
        root,
        "hits",
    )
    by_doc = hits.groupBy("doc_id").agg(F.collect_list(F.struct("place", "lead_doc", "lead_place", "tag")).alias("hits"))
    by_lead = (
        hits.where("doc_id <> lead_doc").select(F.col("lead_doc").alias("doc_id"), "lead_place", "key").distinct().groupBy("doc_id").agg(F.collect_list(F.struct("lead_place", "key")).alias("wanted"))
    )
    found = stored(
        spark,
        docs.join(by_doc.join(by_lead, "doc_id", "full"), "doc_id").mapInArrow(partial(_matches, size=size), _FOUND),
        root,
        "matches",
    )
    matches = found.where(F.col("kind") == MATCH)
    beside = found.where(F.col("kind") == BESIDE)
    left = beside.select(F.col("doc_id").alias("lead_doc"), F.col("place").alias("lead_first"), F.col("left").alias("lead_left"))
    right = beside.select(F.col("doc_id").alias("lead_doc"), F.col("place").alias("lead_last"), F.col("right").alias("lead_right"))
    spans = matches.join(left, ["lead_doc", "lead_first"]).join(right, ["lead_doc", "lead_last"]).mapInArrow(
        _extend, f"doc_id long, tag long, spans {_SPANS}"
    )
    # stretches of a row touch and so are one in the end: each may have the characters of all
    further = (
        repeated(found.where(F.col("kind") == STRETCH), lambda x: stored(spark, x, root, "stretches"), ("char_start", "char_end", "tag", "step", "run"))
        .where("doc_id <> lead_doc")
        .selectExpr(
            "doc_id",
            "tag",
            f"""transform(sequence(place, place + step * (run - 1), step), x -> named_struct('start', x, 'end', x + {size}L, 'char_start', char_start,
                'char_end', char_end, 'match_doc_id', lead_doc, 'match_start', lead_place)) AS spans""",
        )
    )
    # a document has no more spans than words
    return (
        spans.unionByName(further)
        .groupBy("doc_id", "tag")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
        .mapInArrow(
            partial(_stretches, min_words=min_words),
            "doc_id long, text_hash long, start_word long, n_words long, start_char long, n_chars long, match_doc_id long, match_start_word long",
        )
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the passages that earlier documents hold; n_chars follows, if there is one.

    A document of which nothing but white space is left goes; all others stay, and
    those without a repeat stay as they are.
    """
    cuts = (
        repeated_passages(spark, docs, min_words)
        .groupBy(F.col("doc_id").alias("__cut_id"), F.col("text_hash").alias("__cut_text"))
        .agg(F.sort_array(F.collect_list(F.struct("start_char", "n_chars"))).alias("__cuts"))
    )
    schema, columns = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            cut = [i for i, c in enumerate(batch.column("__cuts")) if c.is_valid]
            arrays = [batch.column(c) for c in columns]
            if not cut:
                yield pa.RecordBatch.from_arrays(arrays, names=columns)
                continue
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in columns else None
            keep = np.ones(len(texts), bool)
            for i in cut:
                kept, at = [], 0
                for c in batch.column("__cuts")[i].as_py():
                    kept.append(texts[i][at : c["start_char"]])
                    at = c["start_char"] + c["n_chars"]
                texts[i] = "".join((*kept, texts[i][at:]))
                keep[i] = bool(texts[i].strip())
                if sizes:
                    sizes[i] = len(texts[i])
            arrays[columns.index("text")] = pa.array(texts, arrays[columns.index("text")].type)
            if sizes:
                arrays[columns.index("n_chars")] = pa.array(sizes, arrays[columns.index("n_chars")].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep))

    return docs.join(cuts, (F.col("doc_id") == F.col("__cut_id")) & (F.xxhash64("text") == F.col("__cut_text")), "left").mapInArrow(run, schema)
