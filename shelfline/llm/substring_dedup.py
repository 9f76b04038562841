"""Repeated lines and sentences, by hashing units and grouping the digests of the whole corpus.

Whole lines are compared with whole lines, however short they are: of equal ones the
first by (doc_id, place) stays, and every later one goes. Lines are also parted into
sentences behind ``.``, ``!`` and ``?``, so that a passage inside a paragraph is found as
well. Later occurrences of a sentence go where they stand in an unbroken row of at least
``min_chars`` characters of repeated ones, so that small talk like "Of." does not tear
holes into clean lines. Lines and sentences are normalised to their words in lower case
(A-Z) and hashed to 63 bits, all digests in one global sort; those without a word belong
to the one before. Offsets are those of the original text.

A digest that a third of all lines share costs nothing special: the sort is by range over
digest and place, and splits it over tasks.

Cases: null and blank texts have no units. Rows without doc_id are left alone. Rows that
share a doc_id rank as one document, equal places of it only once. Other columns are not
read, and stay as they are in ``cut_units``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfline.llm.sorted_runs import repeated
from shelfline.llm.words import mix, powers, signed, slices, words_of
from shelfline.sources.workspace import new_run_root, stored

MIN_CHARS = 120
#: Low bits of a place: the length of the unit; above them its start.
LENGTH_BITS = 28
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, digest, first character and number of characters of every sentence and every line; digests of lines are odd."""
    words = words_of(texts, lower=True)
    n = len(words.hashes)
    if not n:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    lines = np.r_[0, np.cumsum(words.data == 10)]
    owner = words.owner
    chars = np.r_[0, np.cumsum((words.data & 0xC0) != 0x80)]

    def parted(begins: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first = np.flatnonzero(begins)
        size = np.diff(first, append=n)
        place = np.arange(n) - np.repeat(first, size)
        digests = mix(np.add.reduceat(words.hashes * powers(int(size.max()))[place], first) + size.astype(np.uint64))
        start = chars[words.starts[first]] - chars[words.offsets[owner[first]]]
        stop = np.r_[start[1:], 0]
        last = np.r_[owner[first][1:] != owner[first][:-1], True]
        whole = (chars[words.offsets[1:]] - chars[words.offsets[:-1]])[owner[first]]
        return owner[first], digests & ~np.uint64(1) | np.uint64(kind), start, np.where(last, whole, stop) - start

    line = np.ones(n, bool)
    line[1:] = (owner[1:] != owner[:-1]) | (lines[words.starts[1:]] != lines[words.ends[:-1]])
    sentence = line.copy()
    sentence[1:] |= _STOPS[words.data[words.ends[:-1] - 1]]
    return tuple(np.concatenate(x) for x in zip(parted(sentence, 0), parted(line, 1), strict=True))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        owner, digests, start, length = units(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(digests)), pa.array(ids[owner]), pa.array((start << LENGTH_BITS) | length)],
            names=["key", "doc_id", "place"],
        )


def repeated_units(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows of repeated lines and sentences to remove: doc_id, start_char, n_chars, n_units, keep_doc_id, keep_start_char.

    ``n_units`` counts sentences. ``min_chars`` is for sentences beside which the rest of their line stays.
    """
    root = new_run_root(spark, "units")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(spark, docs.mapInArrow(_units, "key long, doc_id long, place long"), root, "units")
    later = (
        repeated(rows, lambda x: stored(spark, x, root, "runs"))
        .where("doc_id <> lead_doc or place <> lead_place")
        .select(
            "doc_id",
            F.col("key").bitwiseAND(1).alias("line"),
            F.shiftright("place", LENGTH_BITS).alias("start"),
            F.col("place").bitwiseAND((1 << LENGTH_BITS) - 1).alias("length"),
            F.col("lead_doc"),
            F.shiftright("lead_place", LENGTH_BITS).alias("lead_start"),
        )
        .distinct()
    )
    # the sentences of a repeated line are repeated, too; the line comes before them and lends them its first occurrence
    of_line = F.struct((F.col("start") + F.col("length")).alias("stop"), "lead_doc", "lead_start")
    lines_first = Window.partitionBy("doc_id").orderBy("start", F.desc("line"))
    later = (
        later.withColumn("of_line", F.last(F.when(F.col("line") == 1, of_line), ignorenulls=True).over(lines_first))
        .where("line = 0")
        .withColumn("whole", F.coalesce(F.col("of_line.stop") > F.col("start"), F.lit(False)))
    )
    in_order = Window.partitionBy("doc_id").orderBy("start")
    before = F.lag(F.col("start") + F.col("length")).over(in_order)

    def in_rows(found: DataFrame) -> DataFrame:
        new = (~F.col("start").eqNullSafe(before)).cast("int")
        return found.withColumn("new", new).withColumn("row_no", F.sum("new").over(in_order))

    row_chars = F.sum("length").over(Window.partitionBy("doc_id", "row_no"))
    going = in_rows(later).withColumn("row_chars", row_chars).where((F.col("row_chars") >= min_chars) | F.col("whole"))
    return (
        in_rows(going)
        .withColumn("lead", F.when(F.col("whole"), F.struct("of_line.lead_doc", "of_line.lead_start")).otherwise(F.struct("lead_doc", "lead_start")))
        .groupBy("doc_id", "row_no")
        .agg(
            F.min("start").alias("start_char"),
            F.sum("length").alias("n_chars"),
            F.count("*").alias("n_units"),
            F.min_by("lead", "start").alias("lead"),
        )
        .select(
            "doc_id",
            "start_char",
            "n_chars",
            "n_units",
            F.col("lead.lead_doc").alias("keep_doc_id"),
            F.col("lead.lead_start").alias("keep_start_char"),
        )
    )


def cut_units(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the repeated units taken out of ``text``; every row stays."""
    gone = (
        repeated_units(spark, docs, min_chars)
        .groupBy(F.col("doc_id").alias("__cut_id"))
        .agg(F.sort_array(F.collect_list(F.struct("start_char", "n_chars"))).alias("__cuts"))
    )
    # the text between the cuts; substring counts characters from 1
    ends = "concat(array(0L), transform(__cuts, c -> c.start_char + c.n_chars))"
    starts = "concat(transform(__cuts, c -> c.start_char), array(cast(char_length(text) as bigint)))"
    kept = f"array_join(zip_with({ends}, {starts}, (a, b) -> substring(text, cast(a + 1 as int), cast(b - a as int))), '')"
    text = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(F.expr(kept))
    return docs.join(gone, F.col("doc_id") == F.col("__cut_id"), "left").select(
        *(text.alias("text") if c == "text" else F.col(c) for c in docs.columns)
    )
