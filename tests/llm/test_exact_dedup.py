import hashlib
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import exact_dedup


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, (1 << 40) - 1), min_size=1, max_size=300), st.integers(1, 36))
def test_golomb_round_trip(values, shift):
    values = np.array(sorted(values), np.uint64)
    if int(values[-1] >> np.uint64(shift)) > 1 << 22:
        return  # a code that long is never chosen
    assert exact_dedup.rice_decode(exact_dedup.rice_encode(values, shift), len(values), shift).tolist() == values.tolist()


@given(st.binary(max_size=40))
def test_squeezed(text):
    assert exact_dedup.squeezed(text) == re.sub(rb"[\x20\x09-\x0D]+", b" ", text)


def test_groups(spark, frame, odd_rows):
    rows = odd_rows + [(100 + i, f"same  text\n{i % 7}") for i in range(200)] + [(400 + i, f"same text {i % 5}") for i in range(50)]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    expected = sorted(
        (str(d), str(min((x for x in ids if x is not None), default=None)), len(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for d in ids
    )
    got = exact_dedup.exact_groups(spark, frame(rows).repartition(5)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.sha.hex()) for r in got) == expected
    assert sum(r.row == r.keep_row for r in got) == len(groups)
    kept = exact_dedup.drop_exact_copies(spark, frame(rows))
    assert kept.columns == frame(rows).columns
    firsts = [min((x for x in ids if x is not None), default=None) for ids in groups.values()]
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        [str(d) for d in firsts if d is not None] + ["None"] * sum(d is None for d, _ in rows)
    )
    assert exact_dedup.exact_groups(spark, frame([])).count() == 0


def test_texts_that_share_a_digest(spark, frame):
    """Classes are made by the bytes of texts, also where a weak digest is the same for many of them."""

    def weak(text):
        return bytes([sum(text) % 3]) * 32

    rows = [(i, f"text {i % 11}") for i in range(60)] + [(70 + i, f"alone {i}") for i in range(9)]
    rows += [(80, "text 1"), (80, "alone 80"), (None, "text  2"), (None, "nobody's")]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[" ".join(text.split())].append(doc)
    expected = sorted(
        (str(d), str(min((x for x in ids if x is not None), default=None)), len(ids)) for ids in groups.values() for d in ids
    )
    got = exact_dedup.exact_groups(spark, frame(rows).repartition(3), weak).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == expected
    assert sum(r.row == r.keep_row for r in got) == len(groups)


def test_copies_under_shared_ids(spark, frame):
    """Each row is judged by its own text, and rows of other ids change nothing."""

    def kept(rows):
        left = exact_dedup.drop_exact_copies(spark, frame(rows).repartition(3))
        return sorted(((r.doc_id, " ".join(r.text.split())) for r in left.collect()), key=str)

    nameless = [(None, "n"), (None, "n")]
    assert kept([(3, "A"), (7, "A"), (7, "B"), *nameless]) == [(3, "A"), (7, "B"), *nameless]
    assert kept([(7, "a b"), (7, "a  b"), (8, "a b"), (9, "c"), *nameless]) == [(7, "a b"), (9, "c"), *nameless]
    assert kept([(1, "x"), (2, "y"), *nameless]) == [(1, "x"), (2, "y"), *nameless]


def test_rows_behind_the_last_copy_stay(spark, frame):
    """The bitmap of a sender ends with its last copy; the many rows behind that one are no copies."""
    rows = [(0, "twice"), (1, "twice"), *((i, f"text {i}") for i in range(2, 40))]
    kept = exact_dedup.drop_exact_copies(spark, frame(rows).coalesce(1))
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(2, 40)]
