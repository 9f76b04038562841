import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfline.llm import token_alignment as ta

OWN = ta.pair(ta.default_a(), ta.default_b())
LIBRARY = Tokenizer.from_file(ta.default_a())
LIBRARY.encode_special_tokens = True


def plain(text):
    """Groups of one text by the ends that both sides share."""
    if not text:
        return []
    a = LIBRARY.encode(" " + text, add_special_tokens=False).ids
    b = OWN.b.encode(text)
    raw = (" " + text).encode()
    if b"".join(OWN.bytes_a[i] for i in a) != raw or b"".join(OWN.bytes_b[i] for i in b) != raw:
        return []
    ends_a, ends_b = (np.cumsum([len(of[i]) for i in ids]).tolist() for ids, of in ((a, OWN.bytes_a), (b, OWN.bytes_b)))
    shared = sorted(set(ends_a) & set(ends_b))
    groups = [([], []) for _ in shared]
    for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
        for i, end in zip(ids, ends, strict=True):
            groups[next(k for k, s in enumerate(shared) if s >= end)][side].append(i)
    return groups


def brute_force(rows):
    groups = [(doc, plain(text)) for doc, text in rows]
    held = Counter()
    for _, own in groups:
        held.update({(x, y) for a, b in own for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc, own in groups:
        links = [(x, y) for a, b in own for x in a for y in b]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
        out.append((
            doc, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(links),
            sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=str), held


ODD = st.text(alphabet=st.sampled_from(list("abcthe ..,'\t\n\x00\xa0éßΣ一😀▁<|s>12")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_groups(text):
    assert ta.aligned_groups(OWN, text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(ODD, max_size=4), st.integers(0, 3))
def test_words_are_encoded_as_in_their_text(texts, remembered):
    before, ta.WORDS_KNOWN = ta.WORDS_KNOWN, remembered
    try:
        # a mark in a text is never given back, so its ids do not matter
        texts = [t.replace("▁", "x") for t in texts if t]
        assert [x.tolist() for x in OWN.encode_b(texts)] == OWN.b.encode(texts)
    finally:
        ta.WORDS_KNOWN = before


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), max_size=60)), max_size=4))
def test_shared_cuts(docs):
    """Documents of any token sizes; a last token makes both sides equally long."""
    all_a, all_b, first, at = [], [], [0], 0
    for a, b in docs:
        total = max(sum(a), sum(b)) + 1
        a, b = ([*x, total - sum(x)] for x in (a, b))
        all_a += (at + np.cumsum(a)).tolist()
        all_b += (at + np.cumsum(b)).tolist()
        at += total
        first.append(len(all_a))
    got = ta.shared_cuts(np.array(all_a, np.int64), np.array(all_b, np.int64), np.array(first))
    assert got.tolist() == [x in set(all_b) for x in all_a]


def test_long_interval_without_a_cut():
    a = np.r_[np.arange(1, 9000, 2), 9000]
    b = np.r_[np.arange(2, 9000, 2), 9000]
    assert np.flatnonzero(ta.shared_cuts(a, b, np.array([0, len(a)]))).tolist() == [len(a) - 1]


@given(st.lists(st.integers(0, 200_000), unique=True), st.lists(st.integers(1, 5)))
def test_packing(places, times):
    places = np.array(sorted(places), np.int64)
    assert ta.unpack_places(ta.pack_places(places)).tolist() == places.tolist()
    assert ta.unpack_times(ta.pack_times(np.array(times, np.int64)), len(times)).tolist() == times


def test_many_links(monkeypatch):
    texts = ["aaaaaaa bbb aaaaaaaaaaaa", "\n \n  x" * 5]
    usual = ta.Groups(OWN, *OWN.encode(texts)).links()
    monkeypatch.setattr(ta, "MANY_LINKS", 0)
    for x, y in zip(usual, ta.Groups(OWN, *OWN.encode(texts)).links(), strict=True):
        assert x.tolist() == y.tolist()


def test_same_as_brute_force(spark, frame, words, monkeypatch):
    rows = [(i, " ".join(words(i, 40, 60)) + ", Unbelievable ﬁts: naïve\t\tcafé 12345." * (i % 3)) for i in range(40)]
    rows += [(5, "ties and ties"), (5, "ties and ties"), (None, "no id"), (50, None), (51, ""), (52, "▁ not given back"), (53, "a" * 3000), (54, " "), (55, "<s></s><|endoftext|>")]
    found, pairs = ta.alignment(spark, frame(rows).repartition(3), ta.default_a(), ta.default_b())
    expected, held = brute_force(rows)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert {(r.a, r.b): r.documents for r in pairs.collect()} == dict(held)


def test_odd_rows(spark, frame, odd_rows):
    found, _ = ta.alignment(spark, frame(odd_rows), ta.default_a(), ta.default_b())
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(odd_rows)
    assert all(got[i][1:] == (0, 0, 0, 0, 0, 0, "") for i in (1, 2))
    assert got[6].n_groups > 30_000
    assert ta.alignment(spark, frame([]), ta.default_a(), ta.default_b())[0].count() == 0
