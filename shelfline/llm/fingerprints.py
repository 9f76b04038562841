"""Document fingerprints by winnowing, as DataFrame expressions only.

The words of a text give a hash for every ``GRAM`` words in a row (for every text with
fewer words, one hash of them all). Of every ``WINDOW`` hashes in a row the smallest is
chosen, the rightmost of equals, and kept with its position. Texts that share
GRAM + WINDOW - 1 words in a row share a chosen hash at least; what is shorter than
GRAM words in a row is never matched.

Hashes have 31 bits. A chosen hash is held as one long, hash << 32 | ~position, so that the
smallest long is the smallest hash and, of equal ones, the rightmost.

Cases: null and blank texts have an empty fingerprint, as have texts of no words; two
empty fingerprints are alike (1.0), an empty and another one are not (0.0). Equal texts
have equal fingerprints. Rows with equal doc_id follow each other in the order of their
text. A null doc_id comes last in descending order. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRAM = 3
WINDOW = 8
#: Dense ids that differ only in so many last bits are put in order together; where ids lie further apart, more bits.
BLOCK_BITS = 10
GROUP_BITS = 12
#: Ids (8 bytes each) that go to every task at most.
BROADCAST_HEADS = 1_000_000


def winnow_packed(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the column ``name``: the chosen hashes of the column ``text``, packed, in order of position."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def pack(value: Column, at: Column) -> Column:
        return F.shiftleft(value.bitwiseAND(0x7FFFFFFF), 32).bitwiseOR(F.lit(0xFFFFFFFF) - at)

    w = F.col("__words")
    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - GRAM), lambda i: pack(F.xxhash64(*(w[i + j] for j in range(GRAM))), i.cast("long"))
    )
    whole = F.array(pack(F.xxhash64(F.array_join(w, " ")), F.lit(0).cast("long")))
    empty = F.array().cast("array<bigint>")
    hashes = F.when(F.size(w) >= GRAM, grams).when(F.size(w) > 0, whole).otherwise(empty)
    # each column is used several times; separate projections keep Spark from inlining and computing it again
    out = docs.withColumn("__words", words).withColumn("__m1", hashes)
    step = 1
    while step < WINDOW:
        m = F.col(f"__m{step}")
        out = out.withColumn(
            f"__m{2 * step}", F.zip_with(m, F.slice(m, F.lit(step + 1), F.greatest(F.size(m), F.lit(1))), lambda a, b: F.least(a, b))
        )
        step *= 2
    windows = F.greatest(F.size("__m1") - (WINDOW - 1), F.least(F.size("__m1"), F.lit(1)))
    chosen = F.array_distinct(F.slice(F.col(f"__m{WINDOW}"), F.lit(1), windows))
    return out.withColumn(name, chosen).drop("__words", *(c for c in out.columns if c.startswith("__m")))


def unpacked(packed: Column) -> Column:
    """Array of struct hash, position."""
    return F.transform(
        packed,
        lambda p: F.struct(
            F.shiftright(p, 32).cast("int").alias("hash"),
            (F.lit(0xFFFFFFFF) - p.bitwiseAND(0xFFFFFFFF)).cast("int").alias("position"),
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes in two packed fingerprints (Jaccard), 0 to 1."""
    x, y = (F.transform(c, lambda p: F.shiftright(p, 32).cast("int")) for c in (a, b))
    both = F.size(F.array_intersect(x, y))
    every = F.size(F.array_union(x, y))
    return F.when(every == 0, F.lit(1.0)).otherwise(both / F.greatest(every, F.lit(1)))


def as_string(fingerprint: Column) -> Column:
    """The hashes in order of position, eight hexadecimal digits each."""
    return F.array_join(F.transform(fingerprint, lambda p: F.lower(F.lpad(F.hex(p["hash"]), 8, "0"))), "")


def _following(blocks: DataFrame, levels: int = 5) -> DataFrame:
    """Each ``block`` with the next smaller one that there is; the smallest is followed by the largest.

    Blocks are put in order within groups that share all but their last ``GROUP_BITS`` bits, the groups within groups of their own, and
    so on. However the ids are spread, a window sees 4,096 rows at most; the last one, of all groups together, some 64.
    """
    blocks = blocks.select("block", F.shiftright("block", GROUP_BITS).alias("group"))
    inner = Window.partitionBy("group").orderBy(F.col("block").desc())
    within = blocks.withColumn("after", F.lead("block").over(inner))
    groups = blocks.groupBy("group").agg(F.max("block").alias("top"))
    if levels > 1:
        after = _following(groups.select(F.col("group").alias("block")), levels - 1)
        tops = groups.select(F.col("group").alias("next_block"), F.col("top").alias("next_top"))
        groups = after.join(tops, "next_block").select(F.col("of_block").alias("group"), "next_top")
    else:
        outer = Window.orderBy(F.col("group").desc())
        every = outer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        groups = groups.select("group", F.coalesce(F.lead("top").over(outer), F.max("top").over(every)).alias("next_top"))
    return within.join(groups, "group").select(F.col("block").alias("of_block"), F.coalesce("after", "next_top").alias("next_block"))


def block_bits(docs: DataFrame) -> int:
    """Last bits of an id within a block, so that a block has some 2 ** BLOCK_BITS documents where ids lie closest."""
    shares = [i / 10 for i in range(11)]
    r = docs.agg(F.count("doc_id").alias("n"), F.percentile_approx("doc_id", shares).alias("at")).first()
    gaps = [b - a for a, b in zip(r["at"][:-1], r["at"][1:], strict=True)] if r["at"] else []
    apart = 10 * min(gaps, default=0) // max(1, r["n"])
    return min(60, BLOCK_BITS + max(0, apart.bit_length() - 1))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, packed fingerprint) with next_text and next_fingerprint: of the next smaller doc_id.

    The row after the last one is the first. Rows are put in order in blocks of
    neighbouring ids; a copy of the first row of each block goes to the block before, so
    that its last row finds it there. Texts are shuffled once. The list of first ids, one for
    each block, goes to every task up to ``BROADCAST_HEADS`` entries and is joined by a shuffle beyond.
    """
    # ids without a number get a block below all others
    block = F.coalesce(F.shiftright("doc_id", block_bits(docs)), F.lit(-(1 << 60))).alias("block")
    blocks = docs.groupBy(block).agg(F.max("doc_id").alias("head"))
    heads = (
        _following(blocks.select("block"))
        .join(blocks, F.col("next_block") == F.col("block"))
        .select("head", F.col("of_block").alias("copy_to"))
    )
    heads = F.broadcast(heads) if blocks.count() <= BROADCAST_HEADS else heads
    placed = docs.join(heads, F.col("doc_id").eqNullSafe(F.col("head")), "left").select(
        "doc_id",
        "text",
        "fingerprint",
        F.explode(
            F.filter(
                F.array(
                    F.struct(block, F.lit(False).alias("copy")),
                    F.struct(F.col("copy_to").alias("block"), F.lit(True).alias("copy")),
                ),
                lambda p: p["block"].isNotNull(),
            )
        ).alias("place"),
    ).select("doc_id", "text", "fingerprint", "place.block", "place.copy")
    order = Window.partitionBy("block").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "fingerprint")]
    return placed.select("doc_id", "text", "fingerprint", "copy", *following).where("not copy").drop("copy")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half replaced by as many first characters of ``other``, or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text and fingerprint (hashes with positions); a null text is an empty one."""
    return _packed_prints(docs).withColumn("fingerprint", unpacked(F.col("fingerprint")))


def _packed_prints(docs: DataFrame) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return winnow_packed(docs, "text", "fingerprint")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edited texts, and how alike they are."""
    rows = with_next(_packed_prints(docs))
    rows = rows.select(
        "doc_id",
        "fingerprint",
        F.length("text").cast("long").alias("n_chars"),
        edited(F.col("text"), F.col("next_text")).alias("edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
    rows = winnow_packed(rows, "edited", "edited_fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        unpacked(F.col("fingerprint")).alias("fingerprint"),
        unpacked(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        "near_next",
    )
