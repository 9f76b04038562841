import random
import re
from collections import Counter
from itertools import permutations

import pytest

from shelfline.llm import filter_audit

KEEPS = " ".join(f"word{i}" for i in range(60))


def plain_mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        (len(words) < 50)
        + 2 * (100 * len(set(words)) < 65 * len(words))
        + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        + 8 * bool(re.search(r"[#$%&*|]", text))
    )


def brute_force(rows, labels):
    """All orders, one document at a time. Rows: doc_id, text, source."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    masks = []
    for doc, text, source in rows:
        copy = doc is not None and any(d is not None and d < doc and (t or "") == (text or "") for d, t, _ in rows)
        masks.append((doc, source or "", plain_mask(text or "") + 16 * copy))
    out = {}
    shapley = Counter()
    for order in permutations("ABCDE"):
        removed_before = [False] * len(masks)
        for step, letter in enumerate(order, 1):
            bit = 1 << "ABCDE".index(letter)
            for part in {p for _, p, _ in masks}:
                out[part, "".join(order), step] = Counter(kept=0)
            for i, (doc, part, mask) in enumerate(masks):
                c = out[part, "".join(order), step]
                c["unique_fails"] += mask == bit
                if mask & bit and removed_before[i]:
                    c["redundant"] += 1
                elif mask & bit:
                    c["removed"] += 1
                    shapley[part, letter] += 1
                    c["good_lost"] += doc in good
                    c["toxic_lost"] += doc in toxic
                    removed_before[i] = True
                c["kept"] += not removed_before[i]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {k: (*(c[n] for n in names), shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def run(spark, tmp_path, rows, labels, files, rounds):
    frame = spark.createDataFrame([(d, t, s, "k", 1) for d, t, s in rows], "doc_id long, text string, source string, part string, n int")
    frame.repartition(files).write.parquet(f"{tmp_path}/documents.parquet")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    counters = filter_audit.part_counters(spark, f"{tmp_path}/documents.parquet", labelled, rounds)
    got = filter_audit.audit(spark, counters).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}, len(got)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = [None, "", " ", KEEPS, KEEPS + " #", KEEPS.upper(), "x " * 90, "Short & LOUD", "x " * 90 + "\t|", "É" * 30 + "A"]
    texts += [KEEPS + f" own{i}" for i in range(20)]
    rows = [(i, rng.choice(texts), rng.choice(["web", "books", "", None])) for i in rng.sample(range(10_000), 160)]
    rows += [rows[0]] * 3 + [(rows[1][0], "another text", "web"), (None, KEEPS, "web"), (None, KEEPS, "web"), (20_000, KEEPS, "other")]
    # one text, its ids falling, so that each file retracts what was the first
    return rows + [(30_000 - i, "falling " + KEEPS, ["web", "books"][i % 2]) for i in range(40)]


@pytest.mark.parametrize(("files", "rounds"), [(1, 1), (7, 7)])
def test_same_as_brute_force(spark, tmp_path, rows, files, rounds):
    rng = random.Random(5)
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1])) for d, _, _ in rows if d is not None and rng.random() < 0.6]
    got, n = run(spark, tmp_path, rows, labels + [(None, 1, 1), (99_999, 1, 1)], files, rounds)
    expected = brute_force(rows, labels)
    assert n == len(got) == 600 * len({p for p, _, _ in expected})
    assert got == expected


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, [], [], 1, 1) == ({}, 0)


def test_retraction():
    rng = random.Random(2)
    for _ in range(200):
        rows = [(rng.randrange(12), rng.choice("xy"), rng.choice("pq")) for _ in range(rng.randrange(1, 15))]
        held, changes = {}, Counter()
        for doc, text, part in rows:
            filter_audit.arrive(held, changes, text.encode(), part, 3, doc % 2, 0, doc, 1, 1)
        expected = Counter()
        for doc, text, part in rows:
            copy = any(d < doc and t == text for d, t, _ in rows)
            expected[part, 3 + 16 * copy, doc % 2, 0] += 1
        assert +changes == expected and not -changes


def test_combined_rows():
    import pyarrow as pa

    rows = [(b"a" * 32, "p", 1, 0, 0, d, n) for d, n in [(5, 1), (3, 2), (3, 1), (9, 4), (None, 7), (None, 1)]]
    names = ["sha", "part", "mask", "good", "toxic", "doc_id", "n"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])
    (out,) = filter_audit._combine(64)(iter([batch]))
    assert sorted((r["low"], r["n_low"], r["n"]) for r in out.to_pylist() if r["low"]) == [(3, 3, 8)]
    assert [(r["n_low"], r["n"]) for r in out.to_pylist() if r["low"] is None] == [(0, 8)]


def test_masks():
    for text in ["", "a", "A b", KEEPS, KEEPS.upper(), "x\x1cy z\x0b" * 30, "é" * 99 + "ABCDE", "é" * 95 + "ABCDE", "1 2|", "a " * 49 + "b"]:
        assert filter_audit.text_mask(text.encode(), len(text)) == plain_mask(text)
