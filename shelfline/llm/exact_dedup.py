"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every sender (at most ``CHUNK_ROWS`` documents of one input split) writes its rows with their digests into a table that
   is bucketed by sender. From here on its rows stay where they are: what is joined or grouped by sender is brought to them.
2. A sender sorts the fingerprints of its normalised texts and sends them, Golomb-Rice coded, to the
   owners of the fingerprint ranges. Copies within a sender travel once, so a text
   that makes up a third of all rows costs one code per sender.
3. An owner decodes what it got and answers each sender with a bitmap: which of its
   fingerprints somebody else has, too.
4. Only documents so marked (or repeated within their sender) are suspects. Their
   texts are shuffled and grouped byte by byte; a class is a text that occurs several
   times. Each sender is told the class of each of its different suspect texts, once, and gives it to its rows, so a class
   of any size takes as many rows as it has senders.

Fingerprints are cut from SHA-256 to some 16 bits more than the row count needs, so
about one document in 65,000 becomes a suspect by chance and is cleared in step 4. Rows find the class of their text by
SHA-256 and a second digest; should two texts share both, the run stops.

The bucketed table is entered in the session's catalog for the time of the run; a run that is lost on the way leaves an entry
``exact_...`` and its files below the shared folder.

Cases: a null text is empty, and empty texts are copies of each other. Among equal
texts the smallest doc_id stays; of rows that also share the doc_id, one stays. A
null doc_id ranks last. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.words import slices
from shelfline.sources.workspace import new_run_root, stored

CHUNK_ROWS = 1 << 16
#: Fingerprints that one owner gets, about.
OWNER_ROWS = 1 << 20
#: Tables between the documents and the classes.
_ON_THE_WAY = ("rows", "marks", "suspects", "groups")
_BLANK = b" \t\n\x0b\x0c\r"


def squeezed(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    parts = text.split()
    if not parts:
        return b" " if text else b""
    body = b" ".join(parts)
    return (b" " if text[0] in _BLANK else b"") + body + (b" " if text[-1] in _BLANK else b"")


def sha256(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def rice_encode(values: np.ndarray, shift: int) -> bytes:
    """Sorted distinct values as gaps: quotients in unary, then the remainders of ``shift`` bits each."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    bits = (gaps[:, None] >> np.arange(shift, dtype=np.uint64)[None]) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def rice_decode(code: bytes, n: int, shift: int) -> np.ndarray:
    raw = np.frombuffer(code, np.uint8)
    tail = (n * shift + 7) // 8
    unary = np.unpackbits(raw[: len(raw) - tail])
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    bits = np.unpackbits(raw[len(raw) - tail :])[: n * shift].reshape(n, shift).astype(np.uint64)
    rest = (bits << np.arange(shift, dtype=np.uint64)[None]).sum(axis=1, dtype=np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(shift)) + rest)


def _digests(batches: Iterator[pa.RecordBatch], text: str, digest: Callable[[bytes], bytes]) -> Iterator[pa.RecordBatch]:
    """The same rows with their sender, their place in it, and two digests of their normalised text."""
    part, row = TaskContext.get().partitionId(), 0
    for batch in slices(batches, text):
        norms = [squeezed(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()]
        rows = np.arange(row, row + len(norms))
        row += len(norms)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array((np.int64(part) << 24) + rows // CHUNK_ROWS),
                pa.array((rows % CHUNK_ROWS).astype(np.int32)),
                pa.array([digest(t) for t in norms], pa.binary()),
                pa.array([hashlib.blake2b(t, digest_size=8).digest() for t in norms], pa.binary()),
            ],
            names=[*batch.schema.names, "sender", "place", "sha", "check"],
        )


def _coder(bits: int, owner_bits: int):
    """Fingerprint bits in all, and the leading ones that name the owner."""

    def fingerprints(shas: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(s[:8]) for s in shas), ">u8").astype(np.uint64) >> np.uint64(64 - bits)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(fingerprints(pdf["sha"]))
        owners = (values >> np.uint64(bits - owner_bits)).astype(np.int64)
        out = []
        for owner in np.unique(owners):
            own = values[owners == owner] & np.uint64((1 << (bits - owner_bits)) - 1)
            shift = max(1, int(math.log2((1 << (bits - owner_bits)) / len(own))))
            out.append((pdf["sender"].iat[0], owner, len(own), shift, rice_encode(own, shift)))
        return pd.DataFrame(out, columns=["to_sender", "owner", "n", "shift", "code"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        own = [rice_decode(r.code, r.n, r.shift) for r in pdf.itertuples()]
        _, place, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        shared = np.split(counts[place] > 1, np.cumsum([len(x) for x in own])[:-1])
        return pd.DataFrame(
            {"to_sender": pdf["to_sender"], "owner": pdf["owner"], "n": pdf["n"], "bitmap": [np.packbits(x).tobytes() for x in shared]}
        )

    def mark(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """The suspects of a sender, as a bit for each place."""
        values, at, counts = np.unique(fingerprints(pdf["sha"]), return_inverse=True, return_counts=True)
        answers = answers.sort_values("owner")
        shared = np.concatenate([np.unpackbits(np.frombuffer(r.bitmap, np.uint8))[: r.n] for r in answers.itertuples()])
        suspect = (shared.astype(bool) | (counts > 1))[at]
        return _bitmap(pdf["sender"].iat[0], pdf["place"].to_numpy()[suspect])

    return send, answer, mark


def _bitmap(sender: int, places: np.ndarray) -> pd.DataFrame:
    bits = np.zeros(int(places.max()) + 1 if len(places) else 0, np.uint8)
    bits[places] = 1
    return pd.DataFrame({"of_sender": [sender], "bits": [np.packbits(bits, bitorder="little").tobytes()]}).iloc[: len(bits)]


def _bitmaps(pdf: pd.DataFrame) -> pd.DataFrame:
    return _bitmap(pdf["sender"].iat[0], pdf["place"].to_numpy())


#: Is the bit of a row's place set in the bitmap of its sender? A bitmap ends at its last set bit: places behind that have no byte.
_MARKED = (
    "coalesce(shiftright(CAST(conv(hex(substring(bits, CAST(place DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), place % 8) & 1 = 1, false)"
)


def _squeeze_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, text):
        norms = [squeezed(t or b"") for t in batch.column(text).cast(pa.binary()).to_pylist()]
        kept = [c for c in batch.schema.names if c != text]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(norms, pa.binary())], names=[*kept, "norm"])


def _assign(pdf: pd.DataFrame, classes: pd.DataFrame) -> pd.DataFrame:
    """Rows of a sender with the class of their text, if there is one."""
    known = {(bytes(r.sha), bytes(r.check)): (r.keep_row, r.keep_id, r.none, r.size) for r in classes.itertuples()}
    rows = pdf["sender"].to_numpy(np.int64) * CHUNK_ROWS + pdf["place"].to_numpy(np.int64)
    found = [known.get((bytes(s), bytes(c))) for s, c in zip(pdf["sha"], pdf["check"], strict=True)]
    ids = pdf["doc"].astype("Int64")
    keep = [ids.iat[i] if f is None else pd.NA if f[2] else int(f[1]) for i, f in enumerate(found)]
    return pd.DataFrame(
        {
            "sender": pdf["sender"],
            "place": pdf["place"],
            "doc_id": ids,
            "row": rows,
            "sha": pdf["sha"],
            "keep_row": [r if f is None else int(f[0]) for r, f in zip(rows.tolist(), found, strict=True)],
            "keep_id": pd.array(keep, "Int64"),
            "group_size": [1 if f is None else int(f[3]) for f in found],
        }
    )


def _exchange(spark: SparkSession, docs: DataFrame, digest: Callable[[bytes], bytes], root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The bucketed rows of ``docs`` (its columns as c0, c1, ...), and the class of each row."""
    text, doc = (f"c{docs.columns.index(c)}" for c in ("text", "doc_id"))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).withColumn("doc", F.col(doc).cast("long"))
    more = [("sender", T.LongType()), ("place", T.IntegerType()), ("sha", T.BinaryType()), ("check", T.BinaryType())]
    schema = T.StructType([*plain.schema.fields, *(T.StructField(c, k) for c, k in more)])
    # as many buckets as a shuffle has partitions, so that a join leaves them as they are
    buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = plain.mapInArrow(partial(_digests, text=text, digest=digest), schema)
    rows.write.format("parquet").bucketBy(buckets, "sender").option("path", f"{root}/rows").saveAsTable(name)
    table = spark.table(name)
    prints = table.select("sender", "place", "doc", "sha", "check")
    n = max(2, prints.count())
    owner_bits = max(4, math.ceil(math.log2(n / OWNER_ROWS)) if n > OWNER_ROWS else 0)
    bits = min(60, math.ceil(math.log2(n)) + 16)
    send, answer, mark = _coder(bits, owner_bits)
    codes = prints.select("sender", "sha").groupBy("sender").applyInPandas(send, "to_sender long, owner long, n long, shift int, code binary")
    answers = codes.groupBy("owner").applyInPandas(answer, "to_sender long, owner long, n long, bitmap binary")
    marks = stored(
        spark,
        prints.select("sender", "place", "sha").groupBy("sender").cogroup(answers.groupBy("to_sender")).applyInPandas(mark, "of_sender long, bits binary"),
        root,
        "marks",
    )
    suspects = stored(
        spark,
        table.select("sender", "place", "doc", "sha", "check", text)
        .join(marks.hint("shuffle_hash"), F.col("sender") == F.col("of_sender"))
        .where(_MARKED)
        .drop("of_sender", "bits")
        .mapInArrow(partial(_squeeze_batches, text=text), "sender long, place int, doc long, sha binary, check binary, norm binary"),
        root,
        "suspects",
    )
    row = F.col("sender") * CHUNK_ROWS + F.col("place")
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", row.alias("row")))
    groups = stored(
        spark, suspects.groupBy("norm", "sha", "check").agg(first.alias("first"), F.count("*").alias("size")).drop("norm"), root, "groups"
    )
    if not groups.groupBy("sha", "check").count().where("count > 1").isEmpty():
        raise ValueError("two texts share both digests")
    classes = groups.where("size > 1").select(
        "sha", "check", F.col("first.none").alias("none"), F.col("first.doc").alias("keep_id"), F.col("first.row").alias("keep_row"), "size"
    )
    # what a sender is told: one row for each of its different suspect texts
    told = suspects.select(F.col("sender").alias("to_sender"), "sha", "check").distinct().join(classes, ["sha", "check"])
    found = prints.groupBy("sender").cogroup(told.groupBy("to_sender")).applyInPandas(
        _assign,
        "sender long, place int, doc_id long, row long, sha binary, keep_row long, keep_id long, group_size long",
    )
    return table, stored(spark, found, root, "found")


def _forget(spark: SparkSession, root: str, names: tuple[str, ...]) -> None:
    """Delete tables of a run that its stored result does not need any more."""
    for name in names:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exact_groups(spark: SparkSession, docs: DataFrame, digest: Callable[[bytes], bytes] = sha256) -> DataFrame:
    """Per row of ``docs``: doc_id, row, sha (of the normalised text), keep_row, keep_id, group_size."""
    root, name = new_run_root(spark, "exact"), f"exact_{uuid4().hex}"
    try:
        _, found = _exchange(spark, docs.select("doc_id", "text"), digest, root, name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _forget(spark, root, _ON_THE_WAY)
    return found.drop("sender", "place")


def drop_exact_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the copies; all columns stay.

    Each row is judged by itself: of equal texts the row with the smallest doc_id stays, and of rows that
    share that, too, one. Rows without doc_id stay: nothing names them.
    """
    root, name = new_run_root(spark, "copies"), f"exact_{uuid4().hex}"
    try:
        table, found = _exchange(spark, docs, sha256, root, name)
        copies = found.where("doc_id is not null and row <> keep_row").select("sender", "place")
        gone = stored(spark, copies.groupBy("sender").applyInPandas(_bitmaps, "of_sender long, bits binary"), root, "gone")
        rows = table.join(gone.hint("shuffle_hash"), F.col("sender") == F.col("of_sender"), "left").where(f"bits is null or not ({_MARKED})")
        kept = stored(spark, rows.select(*[F.col(f"c{i}") for i in range(len(docs.columns))]), root, "kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _forget(spark, root, (*_ON_THE_WAY, "found", "gone"))
    return kept.toDF(*docs.columns)
