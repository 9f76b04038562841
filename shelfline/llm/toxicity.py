"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features are densities of lexicon words, how near they stand to second-person words,
capitals, punctuation and signs of obfuscation. The lexicon is a short list of common
insults and what the labels add: words, and word beginnings of 4 to 6 bytes, that are
far more frequent in toxic documents. It is learned on one half of the labelled sample
and the trees on the other, so the trees see the lexicon as new texts will. A fifth of
the trees' half is kept apart for the calibration.

The fit takes ``SAMPLE`` labelled documents in expectation, chosen by a hash of
doc_id, whatever the size of the corpus; all documents are scored whole. Labels of rows
with crc32(doc_id) mod 5 = 0 are held out and never read for the fit.

Cases: a null text is scored as an empty one. If one of the two labels is missing in the
sample, every score is the share of toxic labels (0.5 without any label). Repeated rows are scored
each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.quality import chance, held_out
from shelfline.llm.text_stats import STATS, text_stats
from shelfline.llm.words import Words, buffers, inverse_powers, mix, powers, signed, slices, words_of

#: Labelled documents that the fit takes in expectation.
SAMPLE = 30_000
#: Learned lexicon entries that go to every task, the heaviest first.
MOST_TERMS = 20_000
LEAST_WEIGHT = 2.0
TREES, DEPTH, RATE, BINS = 120, 4, 0.12, 32

INSULTS = (
    "idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown dumb fool imbecile "
    "jerk bastard bitch idiota estupido imbécil basura asqueroso inútil idiote imbécile ordure minable dégoûtant "
    "nul dumm dummkopf abschaum erbärmlich widerlich wertlos versager"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú usted vosotros".split()

_PREFIXES = (4, 5, 6)
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LEET = np.arange(256, dtype=np.uint8)
for _from, _to in zip(b"013457@$!", b"oieastasi", strict=True):
    _LEET[_from] = _to
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
FEATURES = (
    "hits", "density", "kinds", "weight", "heaviest", "second", "strong", "strong_density", "strong_kinds",
    "near_you", "you_density", "hits_upper", "hits_marked", "hits_disguised", "disguised", "stretched", *STATS,
)


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term hashes of every word (whole, then beginnings; 0 where there is none), and its bounds without punctuation."""
    starts, ends = words.starts.copy(), words.ends.copy()
    for _ in range(4):
        ends -= _PUNCT[words.data[ends - 1]] & (ends - starts > 1)
        starts += _PUNCT[words.data[starts]] & (ends - starts > 1)
    n = len(words.data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[_LEET[words.data]] * powers(n), out=sums[1:])
    inverse = inverse_powers(n + 1)
    found = [mix((sums[ends] - sums[starts]) * inverse[starts])]
    for k in _PREFIXES:
        stop = np.minimum(starts + k, ends)
        value = mix((sums[stop] - sums[starts]) * inverse[starts] + np.uint64(k))
        found.append(np.where(ends - starts > k, value, np.uint64(0)))
    return np.array(found), starts, ends


def _hashes_of(texts: list[str]) -> np.ndarray:
    return _terms(words_of(pa.array([" ".join(texts)]), lower=True))[0][0]


def _one_per_document(owners: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, owners))
    o, v = owners[order], values[order]
    new = np.r_[True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])] if len(o) else np.zeros(0, bool)
    return o[new], v[new]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: list[pd.DataFrame] = []
    for batch in slices(batches):
        words = words_of(batch.column("text"), lower=True)
        if not len(words.hashes):
            continue
        terms, _, _ = _terms(words)
        owners = np.tile(words.owner, len(terms))
        o, v = _one_per_document(owners[terms.ravel() != 0], terms.ravel()[terms.ravel() != 0])
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[o]
        seen.append(pd.DataFrame({"term": signed(v), "toxic": toxic, "clean": 1 - toxic}).groupby("term").sum())
        if len(seen) > 20:
            seen = [pd.concat(seen).groupby(level=0).sum()]
    if seen:
        rows = pd.concat(seen).groupby(level=0).sum().reset_index()
        yield pa.RecordBatch.from_pandas(rows.astype("int64"), preserve_index=False)


@dataclass
class Lexicon:
    terms: np.ndarray
    weights: np.ndarray

    def look_up(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.zeros(terms.shape)
        k = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[k] == terms, self.weights[k], 0.0)


def learn_lexicon(sample: DataFrame, toxic: int, clean: int) -> Lexicon:
    """Insults of the list, and terms of ``sample`` (text, toxic) that mark toxic documents."""
    least = max(3, toxic // 100)
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    rows = (
        sample.mapInArrow(_count_terms, "term long, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= least)
        .withColumn("weight", weight)
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.col("weight").desc(), "term")
        .limit(MOST_TERMS)
        .toPandas()
    )
    known = dict(zip(_hashes_of(INSULTS).tolist(), [5.0] * len(INSULTS), strict=True))
    known |= dict(zip(rows["term"].to_numpy(np.int64).view(np.uint64).tolist(), rows["weight"].tolist(), strict=True))
    terms = np.array(sorted(known), np.uint64)
    return Lexicon(terms, np.array([known[t] for t in terms.tolist()]))


def features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row per text, columns as in ``FEATURES``."""
    words = words_of(texts, lower=True)
    n = len(words.offsets) - 1
    stats = text_stats(texts, words)
    out = np.zeros((n, len(FEATURES) - len(STATS)))
    if not len(words.hashes):
        return np.column_stack([out, stats])
    owner, count = words.owner, np.maximum(np.diff(words.first), 1)
    terms, starts, ends = _terms(words)
    weights = lexicon.look_up(terms)
    weight, by = weights.max(axis=0), weights.argmax(axis=0)

    def total(values: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bincount(owner[at], weights=values, minlength=n)

    hit, strong = np.flatnonzero(weight > 0), np.flatnonzero(weight >= 4)
    kinds, _ = _one_per_document(owner[hit], terms[by[hit], hit])
    strong_kinds, _ = _one_per_document(owner[strong], terms[by[strong], strong])
    you = np.isin(terms[0], _hashes_of(SECOND_PERSON))
    reach = np.r_[0, np.cumsum(you)]
    low, high = np.maximum(hit - 5, words.first[owner[hit]]), np.minimum(hit + 6, words.first[owner[hit] + 1])
    near = reach[high] > reach[low]
    original, _ = buffers(texts)
    upper = np.r_[0, np.cumsum((original >= 65) & (original <= 90))]
    all_upper = (upper[ends] - upper[starts] == ends - starts) & (ends - starts > 2)
    letters = np.r_[0, np.cumsum(_LETTER[words.data])]
    inner = letters[ends] - letters[starts]
    disguised = (inner > 1) & (inner < ends - starts)
    same = np.zeros(len(words.data) + 1, np.int64)
    same[3:] = np.cumsum((words.data[2:] == words.data[1:-1]) & (words.data[1:-1] == words.data[:-2]))[: len(same) - 3] if len(words.data) > 2 else 0
    stretched = (ends - starts > 3) & (same[ends] > same[np.minimum(starts + 2, ends)])
    marked = words.data[words.ends - 1] == ord("!")
    heaviest, second = np.zeros(n), np.zeros(n)
    if len(hit):
        order = np.lexsort((-weight[hit], owner[hit]))
        o, w = owner[hit][order], weight[hit][order]
        first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
        heaviest[o[first]] = w[first]
        follow = first + 1
        follow = follow[(follow < len(o))]
        follow = follow[o[follow] == o[follow - 1]]
        second[o[follow]] = w[follow]
    hits, strongs, yous = total(np.ones(len(hit)), hit), total(np.ones(len(strong)), strong), np.bincount(owner, weights=you, minlength=n)
    safe = np.maximum(hits, 1)
    dense = np.column_stack(
        [
            hits,
            hits / count,
            np.bincount(kinds, minlength=n),
            total(weight[hit], hit) / np.sqrt(count),
            heaviest,
            second,
            strongs,
            strongs / count,
            np.bincount(strong_kinds, minlength=n),
            total(near.astype(float), hit) / safe,
            yous / count,
            total(all_upper[hit].astype(float), hit) / safe,
            total(marked[hit].astype(float), hit) / safe,
            total(disguised[hit].astype(float), hit) / safe,
            np.bincount(owner, weights=disguised, minlength=n) / count,
            np.bincount(owner, weights=stretched, minlength=n) / count,
        ]
    )
    return np.column_stack([dense, stats])


@dataclass
class Boosted:
    """Trees over binned features, and the calibration of their sum."""

    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0
    calibration: tuple[np.ndarray, np.ndarray] | None = None
    constant: float | None = None

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.binned(x), np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
            total += value[at - (2**DEPTH - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        raw = self.raw(x)
        plain = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        if self.calibration is None:
            return plain
        # a hundredth of the plain score keeps the order within the flat parts
        return 0.99 * np.interp(raw, *self.calibration) + 0.01 * plain


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: raw scores and the non-decreasing share of label 1."""
    order = np.argsort(raw, kind="stable")
    points, firsts = np.unique(raw[order], return_index=True)
    ones = np.add.reduceat(label[order].astype(float), firsts)
    sizes = np.diff(firsts, append=len(raw)).astype(float)
    pools: list[list[float]] = []
    for i in range(len(points)):
        pools.append([ones[i], sizes[i], i, i])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            one, size, _, last = pools.pop()
            pools[-1][0] += one
            pools[-1][1] += size
            pools[-1][3] = last
    xs, ys = [], []
    for one, size, first, last in pools:
        share = (one + 0.1) / (size + 0.2)
        xs += [points[int(first)], points[int(last)]]
        ys += [share, share]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def boost(x: np.ndarray, y: np.ndarray) -> Boosted:
    """Logistic loss, second-order leaf values, trees of fixed depth over quantile bins."""
    if not len(y) or y.min() == y.max():
        return Boosted(constant=float(y.mean()) if len(y) else 0.5)
    grid = np.linspace(0, 1, BINS)[1:-1]
    cuts = []
    for j in range(x.shape[1]):
        above = x[x[:, j] > x[:, j].min(), j]
        cuts.append(np.unique(np.r_[x[:, j].min(), np.quantile(above, grid) if len(above) else []]))
    model = Boosted(cuts, start=float(np.log(y.mean() / (1 - y.mean()))))
    bins = model.binned(x)
    d, width = x.shape[1], BINS + 1
    total = np.full(len(y), model.start)
    flat = bins + np.arange(d) * width
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, width)
        at = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            nodes, base = 2**level, 2**level - 1
            cell = ((at - base) * (d * width))[:, None] + flat
            sums = [np.bincount(cell.ravel(), weights=np.repeat(w, d), minlength=nodes * d * width).reshape(nodes, d, width).cumsum(axis=2) for w in (g, h)]
            left_g, left_h = sums
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
            gain[(left_h < 0.5) | (all_h - left_h < 0.5)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            good = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
            feature[base : base + nodes] = np.where(good, best // width, 0)
            cut[base : base + nodes] = np.where(good, best % width, width)
            at = 2 * at + 1 + (bins[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - (2**DEPTH - 1)
        value = -RATE * np.bincount(leaf, weights=g, minlength=2**DEPTH) / (np.bincount(leaf, weights=h, minlength=2**DEPTH) + 1)
        total += value[leaf]
        model.trees.append((feature, cut, value))
    return model


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.trees.score(features(texts, self.lexicon))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on ``labels`` (doc_id, toxic) that are not held out, and the texts of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    known = known.where(chance(known.count(), sample, "toxic")).dropDuplicates(["doc_id"])
    first_half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    rows = docs.join(F.broadcast(known), "doc_id").withColumn("first", first_half)
    counts = {r.toxic: r["count"] for r in known.where(first_half).groupBy("toxic").count().collect()}
    lexicon = learn_lexicon(rows.where("first").select("text", "toxic"), counts.get(1, 0), counts.get(0, 0))

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(batch.column("text"), lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("apart"), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "apart", "x"]
            )

    apart = (F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) == 0).alias("apart")
    found = rows.where("not first").select("text", "toxic", apart).mapInArrow(stats, "toxic long, apart boolean, x array<double>").toPandas()
    x = np.array(found["x"].tolist()).reshape(-1, len(FEATURES))
    y, apart = found["toxic"].to_numpy(np.int64), found["apart"].to_numpy(bool)
    order = np.lexsort((y, *x.T))  # the fit must not depend on the order of the rows
    x, y, apart = x[order], y[order], apart[order]
    trees = boost(x[~apart], y[~apart])
    if trees.constant is None and len(set(y[apart].tolist())) == 2:
        trees.calibration = isotonic(trees.raw(x[apart]), y[apart])
    return ToxicityModel(lexicon, trees)


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(batch.column("text")))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
