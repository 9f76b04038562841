import re
from itertools import combinations
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pytest

from shelfline.llm import ngram_join
from shelfline.llm.words import words_of


def brute_force(rows, n, percent):
    """doc_id -> (set size, smallest doc_id reachable), from all pairs."""
    sets = {}
    for doc, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[doc] = {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} or ({tuple(found)} if found else set())
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def edited(base, changes, seed):
    import random

    rng, out = random.Random(seed), list(base)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def rows():
    from conftest import random_words  # tests/llm/conftest.py

    rows, doc = [], 0
    for group in range(6):
        base = random_words(group, 120 + 30 * group)
        chain = base
        for step in range(12):  # chains: neighbours link, ends need not
            rows.append((doc, " ".join(chain)))
            doc += 1
            chain = edited(chain if group % 2 else base, step % 4, 100 * group + step)
    rows += [(doc + i, t) for i, t in enumerate([None, "", " \n", "a b", "A  B", "a", "the the the the the", "b a"])]
    doc = len(rows)
    # texts of frequent words only, and words that a third of the documents share
    rows += [(doc + i, "the of and " * 3 + " ".join(random_words(i // 2, 60, 5))) for i in range(20)]
    return rows


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_same_as_all_pairs(spark, rows, n, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, links = ngram_join.similar_documents(spark, docs, n, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == brute_force(rows, n, percent)
    assert links.count() > 0


def test_odd_rows(spark, frame, odd_rows):
    found, _ = ngram_join.similar_documents(spark, frame(odd_rows), 3, 90)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert len(got) == len(odd_rows)
    assert [(d, c) for d, _, c in got if d is not None and d != c] == []
    assert {d: n for d, n, _ in got if d in (1, 2, 3, 4, 5)} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}
    kept = ngram_join.drop_near_copies(spark, frame(odd_rows))
    assert kept.count() == len(odd_rows)
    assert kept.columns == frame(odd_rows).columns
    assert ngram_join.drop_near_copies(spark, frame([])).count() == 0


def test_several_texts_under_one_id(spark, words):
    """Rows are documents of their own; brute force over rows, named by their place."""
    base = [words(i, 150) for i in range(4)]
    rows = [(4, base[0]), (4, base[1]), (2, edited(base[0], 1, 5)), (9, edited(base[1], 1, 6)), (9, base[1]), (1, base[2]), (1, base[3])]
    rows += [(8, edited(base[2], 1, 7)), (8, edited(base[2], 1, 7)), (7, edited(base[3], 1, 8)), (7, words(99, 150))]
    rows = [(d, " ".join(t)) for d, t in rows]
    found, _ = ngram_join.similar_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    by_row = brute_force(list(enumerate(t for _, t in rows)), 3, 90)
    members = {}
    for i, (_, root) in by_row.items():
        members.setdefault(root, []).append(rows[i][0])
    expected = sorted((rows[i][0], n, min(members[root])) for i, (n, root) in by_row.items())
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == expected


def test_a_decision_is_about_a_row(spark, words):
    a, b, c = (" ".join(words(i, 200)) for i in range(3))
    near = " ".join(edited(a.split(), 2, 1))
    rows = [(1, a), (5, near), (5, b), (6, c), (6, " ".join(edited(c.split(), 2, 2))), (3, None), (3, "")]
    kept = ngram_join.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in kept} - {(6, c), rows[4]} == {(1, a), (5, b), (3, None), (3, "")}
    assert len([r for r in kept if r.doc_id == 6]) == 1


def test_ranks_over_sort_partitions(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    rows = [(i * 7 % 101, i % 13, i, 0) for i in range(150)] + [(50, i % 9, 1000 + i, 0) for i in range(300)]
    members = spark.createDataFrame(rows, "cluster long, size long, node long, component long")
    got = ngram_join._with_tiles(spark, members, str(tmp_path)).collect()
    by_cluster = {}
    for c, s, n, _ in sorted(rows):
        by_cluster.setdefault(c, []).append(n)
    assert {(r.cluster, r.node): r.tile for r in got} == {(c, n): i // 4 for c, ns in by_cluster.items() for i, n in enumerate(ns)}


def test_sets_go_where_they_may_link(spark, rows, monkeypatch, tmp_path):
    """Every row that brings its whole set to a pair of tiles has a possible link there."""
    monkeypatch.setattr(ngram_join, "TILE", 3)
    multiply = ngram_join._multiply

    def noted(percent):
        run = multiply(percent)

        def of_tiles(pdf):
            touched, _ = ngram_join._touched(pdf.sort_values("node", ignore_index=True), percent)
            (tmp_path / uuid4().hex).write_text(f"{len(pdf)} {touched.sum()}")
            return run(pdf)

        return of_tiles

    monkeypatch.setattr(ngram_join, "_multiply", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found, links = ngram_join.similar_documents(spark, docs, 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute_force(rows, 5, 80)
    seen = [[int(n) for n in f.read_text().split()] for f in tmp_path.iterdir()]
    assert sum(n for n, _ in seen) > 0
    assert all(n == touched for n, touched in seen)


def test_tile_products_by_bands(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(ngram_join, "BAND", 7)
    keys = [np.unique(rng.choice(60, rng.integers(1, 30))) for _ in range(40)]
    expected = np.array([[len(np.intersect1d(x, y)) for y in keys] for x in keys])
    assert (np.triu(ngram_join._counts(keys), 1) == np.triu(expected, 1)).all()


def test_words_and_hashes():
    texts = ["a b\tc", None, "", "  x y ", "b", "A", "a b"]
    words = words_of(pa.array(texts), lower=True)
    assert np.diff(words.first).tolist() == [3, 0, 0, 1, 1, 1, 2]
    h = words.hashes
    assert h[0] == h[5] == h[6] and h[1] == h[4] == h[7] and len(set(h.tolist())) == 4
    grams, whole = words.grams(2)
    assert whole.tolist() == [True, True, False, False, False, False, True]
    assert grams[0] == grams[6]
    spans, inside = words.spans(2)
    assert inside.tolist() == whole.tolist() and spans[0] == spans[6]
