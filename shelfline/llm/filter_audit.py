"""How filters on documents overlap, per part of the corpus, in every order of application.

1. The files of the table are a stream that is processed in micro-batches until all are read. Of
   each document go on: its id, the SHA-256 of its text, its part, and a mask of the filters that its text fails.
2. Which document is the first of its text is not known until all files are read. Keyed state holds
   the smallest id so far of every text, with what its holders count for. A document with a larger id counts as
   a copy at once. When a smaller id arrives, the holder's earlier mask is retracted from the
   counters of its part and comes back as that of a copy.
3. A micro-batch writes the sums of its changes to a folder of its own, which a repeated
   micro-batch overwrites. The counters (part, mask, labels) are the sums over all micro-batches.
4. Removals, redundant failures and losses at any step depend only on the filters before it, so the 120
   orders are put together from 80 sums for each part.

State is keyed by a prefix of the digest, some ``TEXTS_PER_STATE`` texts to a key, because a call
for each single text would cost more than the work in it. Equal rows of a slice and then, in
every task, rows of equal text, part and labels are added up before they are shuffled, so a text or a part with a third of all rows
sends a few rows from each task. The state store is the session's; on a large cluster choose the RocksDB provider, which
keeps state on disk.

Cases: null and empty texts are empty texts, and copies of each other; they fail A only, and E. A null source
is the part ''. Rows that share doc_id and text are no copies of each other, as none has the
smaller id. Rows without doc_id fail no E and make no other row fail it. Of several label rows for one doc_id, the largest value
counts; documents without one are neither good nor toxic. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfline.llm.words import slices
from shelfline.sources.workspace import new_run_root, stored

FILTERS = "ABCDE"
COPY = 16
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Micro-batches that the files are dealt over, at most.
ROUNDS = 4
TEXTS_PER_STATE = 64
#: Rows that a task adds up before it sends them.
COMBINED_ROWS = 1 << 16


def text_mask(text: bytes, n_chars: int) -> int:
    """Filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    words = text.split()  # of bytes: at ASCII white space
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        + 2 * (100 * len(set(words)) < DISTINCT_PERCENT * len(words))
        + 4 * (100 * capitals > CAPITALS_PERCENT * n_chars)
        + 8 * (len(text.translate(None, MARKS)) < len(text))
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, most=1 << 21):
        text = batch.column("text")
        sizes = pc.fill_null(pc.utf8_length(text), 0).to_pylist()
        rows: Counter = Counter()
        for doc, part, t, n in zip(batch.column("doc_id").to_pylist(), batch.column("source").to_pylist(), text.cast(pa.binary()).to_pylist(), sizes, strict=True):
            t = t or b""
            rows[doc, part or "", hashlib.sha256(t).digest(), text_mask(t, n)] += 1
        columns = [*zip(*rows, strict=True), rows.values()]
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "part", "sha", "mask", "n"]
        )


_COMBINED = "state_key long, sha binary, part string, mask int, good int, toxic int, low long, n_low long, n long"


def _combine(keys: int):
    """Rows of equal text, part and labels as one, with the smallest id among them."""
    names = [c.split()[0] for c in _COMBINED.split(", ")]
    kinds = (pa.int64(), pa.binary(), pa.string(), *[pa.int32()] * 3, *[pa.int64()] * 3)

    def out(rows: dict) -> pa.RecordBatch:
        flat = [
            (int.from_bytes(sha[:8], "big") & (keys - 1), sha, part, mask, good, toxic, *(x if known else (None, 0, x[2])))
            for (sha, part, mask, good, toxic, known), x in rows.items()
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*flat, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict = {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sha", "part", "mask", "good", "toxic", "doc_id", "n")]
            for *key, doc, n in zip(*columns, strict=True):
                key = (*key, doc is not None)
                held = rows.get(key)
                if held is None:
                    rows[key] = [doc, n, n]
                    continue
                held[2] += n
                if doc is None or doc > held[0]:
                    continue
                if doc < held[0]:
                    held[0], held[1] = doc, 0
                held[1] += n
            if len(rows) >= COMBINED_ROWS:
                yield out(rows)
                rows = {}
        if rows:
            yield out(rows)

    return run


def arrive(held: dict, changes: Counter, sha: bytes, part: str, mask: int, good: int, toxic: int, low: int | None, n_low: int, n: int) -> None:
    """Count ``n`` documents of one text, ``n_low`` of which have the id ``low``, the smallest among them.

    ``held`` maps a text to the smallest id so far and its holders (part, good, toxic, number); ``changes``
    takes the counters that go up or down.
    """
    if low is None:
        changes[part, mask, good, toxic] += n
        return
    smallest, holders = held.get(sha, (None, ()))
    if smallest is not None and low > smallest:
        changes[part, mask | COPY, good, toxic] += n
        return
    if smallest is None or low < smallest:
        for was_part, was_good, was_toxic, m in holders:  # copies after all
            changes[was_part, mask, was_good, was_toxic] -= m
            changes[was_part, mask | COPY, was_good, was_toxic] += m
        holders = ()
    held[sha] = (low, (*holders, (part, good, toxic, n_low)))
    changes[part, mask, good, toxic] += n_low
    changes[part, mask | COPY, good, toxic] += n - n_low


def _update(key: tuple[int], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = pickle.loads(state.get[0]) if state.exists else {}
    changes: Counter = Counter()
    columns = ["sha", "part", "mask", "good", "toxic", "low", "n_low", "n"]
    for frame in frames:
        lists = [frame[c].tolist() for c in columns]
        for sha, part, mask, good, toxic, low, n_low, n in zip(*lists, strict=True):
            known = low is not None and low == low
            arrive(held, changes, bytes(sha), part, int(mask), int(good), int(toxic), int(low) if known else None, int(n_low), int(n))
    state.update((pickle.dumps(held, 5),))
    rows = [(*k, n) for k, n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def part_counters(spark: SparkSession, path: str, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Documents of the Parquet table at ``path`` (doc_id, text, source) by part, mask of failed filters, good and toxic."""
    root = new_run_root(spark, "audit")
    table = spark.read.parquet(path)
    n_files = len(table.inputFiles())
    keys = 1 << max(6, (table.count() // TEXTS_PER_STATE).bit_length())
    known = stored(
        spark,
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .withColumn("spread", F.lit(0).cast("long")),
        root,
        "labels",
    )
    # the stream takes a plain path for a folder; as a pattern that matches just itself, it may be a file as well
    path = path.rstrip("/")
    documents = (
        spark.readStream.schema(table.schema)
        .option("maxFilesPerTrigger", max(1, -(-n_files // rounds)))
        .parquet(f"{path[:-1]}[{path[-1]}]")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    )
    # rows without an id find no label, wherever they are sent
    found = documents.mapInArrow(_features, "doc_id long, part string, sha binary, mask int, n long").withColumn(
        "spread", F.when(F.col("doc_id").isNull(), F.xxhash64("sha")).otherwise(0)
    )
    changes = (
        found.join(known, ["doc_id", "spread"], "left")
        .select("doc_id", "part", "sha", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .mapInArrow(_combine(keys), _COMBINED)
        .groupBy("state_key")
        .applyInPandasWithState(_update, "part string, mask int, good int, toxic int, n long", "held binary", "update", GroupStateTimeout.NoTimeout)
    )

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        sums.write.mode("overwrite").parquet(f"{root}/changes/round={number}")

    query = (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", f"{root}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = "part string, mask int, good int, toxic int, n long, round int"
    if not n_files or query.lastProgress is None:
        return spark.createDataFrame([], schema).drop("round")
    return (
        spark.read.schema(schema).parquet(f"{root}/changes")
        .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
    )


def audit(spark: SparkSession, counters: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see the module for the columns."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = [
        ("".join(order), k + 1, bit[f], sum(bit[x] for x in order[:k])) for order in permutations(FILTERS) for k, f in enumerate(order)
    ]
    orders = spark.createDataFrame(steps, "filter_order string, step int, own int, earlier int")
    cases = sorted({(own, earlier) for _, _, own, earlier in steps})
    wanted = F.array(*[F.struct(F.lit(own).alias("own"), F.lit(earlier).alias("earlier")) for own, earlier in cases])
    fails, gone = F.expr("mask & own <> 0"), F.expr("mask & earlier <> 0")

    def documents(when, of="1"):
        return F.sum(F.when(when, F.col("n") * F.expr(of)).otherwise(0)).cast("long")

    sums = (
        counters.select("*", F.inline(wanted))
        .groupBy("part", "own", "earlier")
        .agg(
            documents(~fails & ~gone).alias("kept"),
            documents(fails & ~gone).alias("removed"),
            documents(fails & gone).alias("redundant"),
            documents(F.expr("mask = own")).alias("unique_fails"),
            documents(fails & ~gone, "good").alias("good_lost"),
            documents(fails & ~gone, "toxic").alias("toxic_lost"),
        )
    )
    # so many orders put these filters, and no others, before this one
    size = len(FILTERS)
    weights = {n: factorial(n) * factorial(size - 1 - n) for n in range(size)}
    weight = F.element_at(F.array(*[F.lit(weights[n]) for n in range(size)]), F.bit_count("earlier") + 1)
    shapley = sums.groupBy("part", "own").agg(F.sum(F.col("removed") * weight).cast("long").alias("shapley"))
    return (
        sums.join(shapley, ["part", "own"])
        .join(F.broadcast(orders), ["own", "earlier"])
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )
