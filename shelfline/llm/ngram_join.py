"""Similarity join on n-gram sets: a blocked sparse product of document by n-gram incidence.

Two documents link when their sets of word n-grams have a Jaccard similarity of at
least ``percent`` per cent.

* Equal sets link anyway: the smallest doc_id of a set stands for all of them.
* From a set of n n-grams, only the n - ceil(n * percent / 100) + 1 that come first
  in one common order enter the product; two sets that link share one of these. The
  order puts n-grams with rare words first (counts of all words of the corpus, in a
  table of fixed size), so the blocks of the product, one per n-gram, stay short.
  The order decides the cost only, never the result.
* A block is a run in the sorted order. Overlap counts of each row with the block's
  first document are added up over all blocks, and each document is paired with the
  one it meets most often.
* A pair that shares c of its leading n-grams can share at most c + ceil(max size *
  percent / 100) - 1 in all. Pairs that cannot reach the similarity by this bound or by
  their sizes are discarded, the rest is counted on the whole sets.
* Blocks whose documents are not all connected by now are settled completely: their
  documents, in clusters that share n-grams, are cut into tiles by size, and every pair of tiles
  that the sizes allow is multiplied out in memory, document by n-gram. Only links that
  join two components leave a task. So a group of thousands of near copies costs one row
  per copy and not all pairs, and no link that matters for the components is lost.

Cases: null or blank texts have an empty set and link with nothing, not even with
each other; texts of fewer words than n have one n-gram, the whole sequence. A row is named by its doc_id
and a hash of its text, so rows that share a doc_id but not the text are documents of their own, which link, or not,
by their texts; the result has a row for each. Rows without doc_id are
counted but link with nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.components import components
from shelfline.llm.sorted_runs import repeated
from shelfline.llm.words import Words, mix, signed, slices, words_of
from shelfline.sources.workspace import new_run_root, stored

#: Slots of the table of word counts. It is the only thing that goes to every task, with 8 bytes a slot.
WORD_SLOTS = 1 << 17
#: Names of at most so many documents (24 bytes each) go to every task; beyond, texts are shuffled.
BROADCAST_NODES = 1_000_000
#: Documents in a tile of the product.
TILE = 2_000
#: N-grams of at least so many documents of a tile are multiplied as a dense block.
DENSE_FROM = 8
#: Bytes of an n-gram hash that travel for the exact count.
HASH_BYTES = 8
#: Rows of a tile product that are judged at a time.
BAND = 128


def gram_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of every document: owner, hash and first place (a word index), by owner and hash."""
    hashes, whole = words.grams(n)
    places = np.flatnonzero(whole)
    owner = words.owner
    owners, values = owner[places], hashes[places]
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    if len(short):
        own = []
        for i in short:  # fewer words than n: one n-gram, at most n - 1 steps each
            total = words.hashes[words.first[i] : words.first[i] + 1] + np.uint64(sizes[i])
            for j in range(words.first[i] + 1, words.first[i + 1]):
                total = mix(total) + words.hashes[j : j + 1]
            own.append(mix(total))
        owners = np.r_[owners, short]
        values = np.r_[values, np.concatenate(own)]
        places = np.r_[places, words.first[short]]
    order = np.lexsort((values, owners))
    owners, values, places = owners[order], values[order], places[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    return owners[new], values[new], places[new]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(WORD_SLOTS, np.int64)
    for batch in slices(batches):
        slots = words_of(batch.column("text"), lower=True).hashes & np.uint64(WORD_SLOTS - 1)
        counts += np.bincount(slots.astype(np.int64), minlength=WORD_SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words over all documents, per slot; a table of fixed size."""
    rows = docs.mapInArrow(_count_words, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(WORD_SLOTS, np.int64)
    counts[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return counts


_ROWS = "row long, key long, doc_id long, tag long, n long, sum_a long, sum_b long"


def _rows(n: int, percent: int, counts: np.ndarray):
    """Each document with its number, the size and two sums of its set, and the n-grams of it that enter the product."""
    names = [c.split()[0] for c in _ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            words = words_of(batch.column("text"), lower=True)
            owners, values, places = gram_sets(words, n)
            rows = first + np.arange(batch.num_rows)
            first += batch.num_rows
            sizes = np.bincount(owners, minlength=batch.num_rows)
            sums = np.zeros((2, batch.num_rows), np.uint64)
            if len(owners):
                at = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
                sums[0, owners[at]] = np.add.reduceat(values, at)
                sums[1, owners[at]] = np.add.reduceat(mix(values ^ np.uint64(0x5DEECE66D)), at)
            columns = [pa.array(rows), pa.nulls(len(rows), pa.int64()), batch.column("doc_id"), batch.column("tag"), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(signed(x)) for x in sums)], names=names)
            if not len(owners):
                continue
            seen = counts[(words.hashes & np.uint64(WORD_SLOTS - 1)).astype(np.int64)]
            ends = words.first[owners + 1]
            rarity = seen[places]
            for j in range(1, n):
                near = np.minimum(places + j, ends - 1)
                rarity = np.minimum(rarity, seen[near])
            order = np.lexsort((values, rarity, owners))
            owners, values = owners[order], values[order]
            begin = np.r_[0, np.cumsum(sizes)[:-1]]
            size = sizes[owners]
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            keep = (np.arange(len(owners)) - begin[owners] <= size - (size * percent + 99) // 100) & named[owners]
            none = pa.nulls(int(keep.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(rows[owners[keep]]), pa.array(signed(values[keep])), *[none] * 5], names=names)

    return run


def _pack_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            owners, values, _ = gram_sets(words_of(batch.column("text"), lower=True), n)
            ends = np.cumsum(np.bincount(owners, minlength=batch.num_rows)) * HASH_BYTES
            short = np.ascontiguousarray((values >> np.uint64(64 - 8 * HASH_BYTES)).view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
            data = pa.py_buffer(short.tobytes())
            offsets = pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes())
            grams = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, data])
            along = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in along), grams], names=[*along, "grams"])

    return run


def _unpack(grams: bytes) -> np.ndarray:
    wide = np.zeros((len(grams) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(grams, np.uint8).reshape(-1, HASH_BYTES)
    return wide.view(np.uint64).ravel()


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, last, left = [], None, None
        for a, b in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
            a, b = a.as_py(), b.as_py()
            if a != last:
                last, left = a, _unpack(a)
            counts.append(len(np.intersect1d(left, _unpack(b), assume_unique=True)))
        names = ["a", "b", "a_size", "b_size"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in names), pa.array(counts, pa.int64())], names=[*names, "common"]
        )


def _counts(columns: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the arrays share, above the diagonal: incidence times its transpose."""
    n = len(columns)
    rows = np.repeat(np.arange(n), [len(c) for c in columns])
    values = np.concatenate(columns) if n else np.zeros(0, np.int64)
    total = np.zeros(n * n, np.float32)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    sizes = np.diff(starts, append=len(values))
    # values that few arrays hold: their pairs one by one
    for size in range(2, DENSE_FROM):
        at = starts[sizes == size]
        for x in range(size):
            for y in range(x + 1, size):
                a, b = rows[at + x], rows[at + y]
                np.add.at(total, np.minimum(a, b) * n + np.maximum(a, b), 1)
    total = total.reshape(n, n)
    # the others as blocks of a dense matrix, band by band
    frequent = np.flatnonzero(sizes >= DENSE_FROM)
    for begin in range(0, len(frequent), 1024):
        some = frequent[begin : begin + 1024]
        block = np.zeros((n, len(some)), np.float32)
        held = np.repeat(np.arange(len(some)), sizes[some])
        within = np.arange(len(held)) - np.repeat(np.cumsum(sizes[some]) - sizes[some], sizes[some])
        block[rows[starts[some][held] + within], held] = 1
        for first in range(0, n, BAND):
            total[first : first + BAND, first:] += block[first : first + BAND] @ block[first:].T
    return total


def _allowed(pdf: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of two components that sizes and shared leading n-grams allow to link, some rows at a time; the first comes first."""
    sizes = pdf["size"].to_numpy(np.int64)
    _, root = np.unique(pdf["component"].to_numpy(np.int64), return_inverse=True)
    tile = pdf["tile"].to_numpy()
    two = pdf["first"].iat[0] != pdf["second"].iat[0]  # pairs within a tile have a task of their own
    shared = _counts([np.asarray(k, np.int64) for k in pdf["keys"]])
    for first in range(0, len(pdf), BAND):
        common = shared[first : first + BAND, first:]
        i, j = np.nonzero(np.triu(common > 0, 1))
        common, i, j = common[i, j].astype(np.int64), i + first, j + first
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        allowed = (small * 100 >= large * percent) & (root[i] != root[j])
        allowed &= (common + (large * percent + 99) // 100 - 1) * (100 + percent) >= percent * (small + large)
        if two:
            allowed &= tile[i] != tile[j]
        yield i[allowed], j[allowed]


def _touched(pdf: pd.DataFrame, percent: int) -> tuple[np.ndarray, int]:
    """Rows with an allowed pair, and the number of these pairs."""
    touched, pairs = np.zeros(len(pdf), bool), 0
    for a, b in _allowed(pdf, percent):
        touched[a] = touched[b] = True
        pairs += len(a)
    return touched, pairs


_PLACED = "cluster long, first long, second long, tile long, node long, size long, component long"


def _candidates(percent: int):
    """The documents of two tiles that may link with another component in these tiles."""
    names = [c.split()[0] for c in _PLACED.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        return pdf.loc[_touched(pdf, percent)[0], names]

    return run


def _multiply(percent: int):
    """Links between components among the documents of two tiles, whose whole sets are at hand."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        nodes, sizes = pdf["node"].to_numpy(np.int64), pdf["size"].to_numpy(np.int64)
        touched, pairs = _touched(pdf, percent)
        sets = [_unpack(g) if t else None for g, t in zip(pdf.pop("grams"), touched, strict=True)]
        place = np.cumsum(touched) - 1
        product = _counts([x.view(np.int64) for x in sets if x is not None]) if pairs > 5_000 else None
        _, root = np.unique(pdf["component"].to_numpy(np.int64), return_inverse=True)
        parent = np.arange(root.max() + 1 if len(root) else 0)

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return int(x)

        links = []
        for a, b in _allowed(pdf, percent):
            # what is connected by now needs no further link
            while (parent != parent[parent]).any():
                parent = parent[parent]
            open_pairs = parent[root[a]] != parent[root[b]]
            a, b = a[open_pairs], b[open_pairs]
            if product is not None:
                common = product[place[a], place[b]].astype(np.int64)
            else:
                common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
            linked = common * (100 + percent) >= percent * (sizes[a] + sizes[b])
            for i, j, both in zip(a[linked].tolist(), b[linked].tolist(), common[linked].tolist(), strict=True):
                x, y = find(root[i]), find(root[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((nodes[i], nodes[j], both))
        return pd.DataFrame(links, columns=["a", "b", "common"], dtype="int64")

    return run


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of cluster, size and node, with their place among the rows of their cluster in this partition."""
    part, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cluster = batch.column("cluster").to_numpy()
        starts = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]])
        place = np.arange(len(cluster)) - np.repeat(starts, np.diff(starts, append=len(cluster)))
        if cluster[0] == last:
            place[: starts[1] if len(starts) > 1 else None] += n
        last, n = cluster[-1], place[-1] + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(place), pa.array(np.full(len(cluster), part, np.int32))], names=[*batch.schema.names, "place", "part"]
        )


def _with_tiles(spark: SparkSession, members: DataFrame, root: str) -> DataFrame:
    """``members`` (node, size, component, cluster) with the tile of their cluster, by size.

    The rank within a cluster comes from a range sort. Only a cluster that begins in an earlier partition needs the
    number of its rows there: one row per partition of the sort.
    """
    columns = ("cluster", "size", "node", "component")
    ranked = stored(
        spark,
        members.select(*columns)
        .repartitionByRange("cluster", "size", "node")
        .sortWithinPartitions("cluster", "size", "node")
        .mapInArrow(_ranked, "cluster long, size long, node long, component long, place long, part int"),
        root,
        "ranked",
    )
    parts = ranked.groupBy("part").agg(
        F.min("cluster").alias("first"), F.max("cluster").alias("last"), F.max(F.struct("cluster", "place")).alias("end")
    )
    before, waiting, offsets = None, 0, []
    for r in parts.orderBy("part").collect():
        own = waiting if r.first == before else 0
        offsets.append((r.part, r.first, own))
        waiting = r.end.place + 1 + (own if r.first == r.last else 0)
        before = r.last
    known = spark.createDataFrame(offsets, "of_part int, of_cluster long, earlier long")
    same = (F.col("part") == F.col("of_part")) & (F.col("cluster") == F.col("of_cluster"))
    rank = F.col("place") + F.coalesce("earlier", F.lit(0))
    return ranked.join(F.broadcast(known), same, "left").select(*columns, F.floor(rank / TILE).alias("tile"))


def similar_documents(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, tag, n_shingles, set_id, component_id) and the counted links (a, b, common) between sets.

    ``tag`` is the hash of the row's text; a set is named by the smallest doc_id that has it.
    """
    root = new_run_root(spark, "ngram")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    rows = stored(spark, docs.mapInArrow(_rows(n, percent, word_counts(docs)), _ROWS), root, "rows")
    sizes = rows.where("n is not null").drop("key")
    # a set has the number of one of its rows; the document with the smallest doc_id stands for it
    sets = stored(
        spark,
        sizes.where("n > 0 and doc_id is not null")
        .groupBy("n", "sum_a", "sum_b")
        .agg(F.min(F.struct("doc_id", "tag")).alias("of"), F.min("row").alias("node"))
        .select("n", "sum_a", "sum_b", F.col("of.doc_id").alias("set_id"), F.col("of.tag").alias("set_tag"), "node"),
        root,
        "sets",
    )
    members = stored(
        spark,
        sizes.join(sets, ["n", "sum_a", "sum_b"], "left").select("row", "doc_id", "tag", F.col("n").alias("n_shingles"), "set_id", "node"),
        root,
        "members",
    )
    repeats = not members.where("doc_id is not null").groupBy("doc_id", "tag").count().where("count > 1").isEmpty()
    known = docs.where("doc_id is not null")
    # from here on a row's number takes the place of its doc_id
    firsts = rows.where("key is not null").select("key", F.col("row").alias("doc_id"), F.lit(0).alias("place"))
    names = members.where("node is not null and doc_id is not null").select(F.col("row").alias("doc_id"), "node", F.col("n_shingles").alias("size"))
    blocks = stored(
        spark,
        repeated(firsts, lambda x: stored(spark, x, root, "runs")).join(names, "doc_id").select("key", "node", "size"),
        root,
        "blocks",
    )
    keys = stored(spark, blocks.groupBy("node").agg(F.collect_set("key").alias("keys")), root, "keys")

    def sets_of(nodes: DataFrame, name: str) -> DataFrame:
        """Whole n-gram sets of some documents, from their texts; other columns of the distinct ``nodes`` go along."""
        along = [c for c in nodes.columns if c != "node"]
        of = stored(spark, sets.join(nodes, "node").select("node", *along, F.col("set_id").alias("doc_id"), F.col("set_tag").alias("tag")), root, f"{name}-nodes")
        # few documents find their texts without moving all of them
        wanted = F.broadcast(of) if of.count() <= BROADCAST_NODES else of
        texts = known.join(wanted, ["doc_id", "tag"]).select("node", *along, "text")
        if repeats:  # a row that is repeated has its set once
            texts = texts.dropDuplicates(["node"])
        kinds = "".join(f"{c} long, " for c in along)
        return stored(spark, texts.mapInArrow(_pack_sets(n), f"node long, {kinds}grams binary"), root, name)

    def fits(a: str, b: str):
        return (F.col(f"{a}_size") * 100 >= F.col(f"{b}_size") * percent) & (F.col(f"{b}_size") * 100 >= F.col(f"{a}_size") * percent)

    def counted(pairs: DataFrame, name: str) -> DataFrame:
        """Links among the stored ``pairs`` (a, b, a_size, b_size), one for each b, counted on the whole sets."""
        of = {side: keys.select(F.col("node").alias(side), F.col("keys").alias(f"keys_{side}")) for side in "ab"}
        most = F.ceil(F.greatest("a_size", "b_size") * percent / 100) - 1
        common = F.size(F.array_intersect("keys_a", "keys_b")) + most
        left = stored(
            spark,
            pairs.join(of["b"], "b")
            .join(of["a"], "a")
            .where(common * (100 + percent) >= (F.col("a_size") + F.col("b_size")) * percent)
            .select("a", "b", "a_size", "b_size"),
            root,
            f"{name}-left",
        )
        # the sets of the one side know their other side from the start, so each moves once
        seconds = sets_of(left.select(F.col("b").alias("node"), "a", "a_size", "b_size"), f"{name}-b").withColumnsRenamed({"node": "b", "grams": "grams_b"})
        firsts = sets_of(left.select(F.col("a").alias("node")).distinct(), f"{name}-a").withColumnsRenamed({"node": "a", "grams": "grams_a"})
        common = (
            seconds.join(firsts, "a")
            .select("a", "b", "grams_a", "grams_b", "a_size", "b_size")
            .mapInArrow(_overlaps, "a long, b long, a_size long, b_size long, common long")
        )
        return stored(
            spark,
            common.where(F.col("common") * 100 >= (F.col("a_size") + F.col("b_size") - F.col("common")) * percent)
            .select("a", "b", "common"),
            root,
            name,
        )

    def star(rows: DataFrame, turn: int) -> DataFrame:
        """Each row of a block with the block's centre, and in how many blocks they meet."""
        rank = F.struct((F.xxhash64("node", F.lit(turn)) if turn else F.col("node")).alias("rank"), "node", "size")
        centres = rows.groupBy("key").agg(F.min(rank).alias("centre"))
        first = F.col("node") < F.col("centre.node")
        return (
            rows.join(centres, "key")
            .where("centre.node <> node")
            .select(
                F.least("node", "centre.node").alias("a"),
                F.greatest("node", "centre.node").alias("b"),
                F.when(first, F.col("size")).otherwise(F.col("centre.size")).alias("a_size"),
                F.when(first, F.col("centre.size")).otherwise(F.col("size")).alias("b_size"),
            )
            .groupBy("a", "b", "a_size", "b_size")
            .agg(F.count("*").alias("blocks"))
            .where(fits("a", "b"))
        )

    def still_open(rows: DataFrame, links: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """Labels of the nodes, and the rows of blocks whose nodes are not all connected."""
        labels = components(spark, links)
        named = stored(
            spark,
            rows.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")),
            root,
            f"named-{name}",
        )
        keys = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        return labels, stored(spark, named.join(keys.select("key"), "key", "left_semi"), root, f"open-{name}")

    def multiplied(rows: DataFrame) -> DataFrame:
        """All links between components among the open rows, by products of tiles."""
        first = rows.groupBy("key").agg(F.min("node").alias("a"))
        touching = rows.join(first, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
        clusters = components(spark, touching).select("node", F.col("component").alias("cluster"))
        members = stored(
            spark, _with_tiles(spark, rows.select("node", "size", "component").distinct().join(clusters, "node"), root), root, "members-2"
        )
        tiles = members.groupBy("cluster", "tile").agg(F.min("size").alias("low"), F.max("size").alias("high"))
        second = tiles.select("cluster", F.col("tile").alias("second"), F.col("low").alias("second_low"))
        pairs = (
            tiles.withColumnRenamed("tile", "first")
            .join(second, "cluster")
            .where((F.col("first") <= F.col("second")) & (F.col("second_low") * percent <= F.col("high") * 100))
            .select("cluster", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("tile"))
        )
        # a pair of two components shares open keys only; candidates are found on these, before any whole set moves
        open_keys = stored(spark, rows.groupBy("node").agg(F.collect_set("key").alias("keys")), root, "open-keys")
        placed = stored(spark, members.join(pairs, ["cluster", "tile"]), root, "placed")
        by_tiles = ["cluster", "first", "second"]
        found = stored(spark, placed.join(open_keys, "node").groupBy(*by_tiles).applyInPandas(_candidates(percent), _PLACED), root, "candidates")
        grams = sets_of(found.select("node").distinct(), "sets-2")
        # a whole set goes to those pairs of tiles only in which it may link
        return (
            found.join(open_keys, "node")
            .join(grams, "node")
            .groupBy(*by_tiles)
            .applyInPandas(_multiply(percent), "a long, b long, common long")
        )

    # 1. every row of a block with the one document that it meets most often in the centre
    best = star(blocks, 0).groupBy("b").agg(F.max_by(F.struct("a", "a_size", "b_size"), F.struct("blocks", "a")).alias("x"))
    best = stored(spark, best.select("x.a", "b", "x.a_size", "x.b_size"), root, "best")
    links = counted(best, "links-1")
    labels, rows = still_open(blocks, links, "1")
    # 2. where that did not connect a block, all pairs
    if not rows.isEmpty():
        links = links.union(stored(spark, multiplied(rows), root, "links-2"))
        labels = components(spark, links)
    # a component is named by the smallest doc_id in it
    labelled = sets.select("node", "set_id").join(labels, "node")
    smallest = labelled.groupBy("component").agg(F.min("set_id").alias("component_id"))
    named = labelled.join(smallest, "component").select("node", "component_id")
    found = members.join(named, "node", "left").select(
        "doc_id",
        "tag",
        "n_shingles",
        "set_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "set_id", "doc_id")).alias("component_id"),
    )
    ends = {side: sets.select(F.col("node").alias(side), F.col("set_id").alias(f"{side}_id")) for side in "ab"}
    links = links.join(ends["a"], "a").join(ends["b"], "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "common")
    return found, links


def drop_near_copies(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; rows without doc_id stay.

    Rows are judged by doc_id and text. Where rows that share the smallest doc_id are similar to each other, the one with the
    smallest hash of its text stays; rows that share doc_id and text stay together.
    """
    found, _ = similar_documents(spark, docs, n, percent)
    judged = found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id", "tag").agg(F.min("component_id").alias("component_id"))
    judged = stored(spark, judged, new_run_root(spark, "near"), "judged")
    # ids that stand for a component with several of their texts
    first = judged.where("doc_id = component_id").groupBy("component_id").agg(F.min("tag").alias("first_tag"))
    gone = judged.join(first, "component_id").where("doc_id <> component_id or tag <> first_tag")
    named = gone.select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__tag"))
    return docs.join(named, same, "left_anti")
