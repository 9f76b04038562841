import numpy as np
import pytest

from shelfline.llm import token_counts
from pyspark.sql import functions as F


def brute_force(text, sections, rule):
    """Tokens one by one against every section, in bytes."""
    own, _ = token_counts.encoding(token_counts.default_ranks())
    at = np.cumsum([0, *(len(c.encode()) for c in text)])
    spans = [(at[min(a, len(text))], at[min(b, len(text))]) for a, b in sections]
    counts, place = [0.0] * len(spans), 0
    outside = 0.0
    for token in own.encode_ordinary(text):
        begin, place = place, place + len(own.decode_single_token_bytes(token))
        held = [max(0, min(place, b) - max(begin, a)) for a, b in spans]
        rest = place - begin - sum(held)
        if rule == "share":
            counts = [c + h / (place - begin) for c, h in zip(counts, held, strict=True)]
            outside += rest / (place - begin)
            continue
        byte = begin if rule == "first" else place - 1
        if rule != "most":
            k = [i for i, (a, b) in enumerate(spans) if a <= byte < b]
        else:
            # areas in order, those between the sections included
            points = sorted({0, at[-1], *(x for s in spans for x in s)})
            areas = [(min(place, b) - max(begin, a), a, b) for a, b in zip(points, points[1:], strict=False)]
            most = max(areas, key=lambda x: (x[0], -x[1]))
            k = [i for i, s in enumerate(spans) if s == most[1:]]
        if k:
            counts[k[0]] += 1
        else:
            outside += 1
    return counts, outside


TEXTS = ["one line\nand  the next\n\n\n  with blanks ...\nend", "", "é😀ü\n日本語 text\n", "\n\n\n", "no end", "a\r\nb"]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_lines(spark, rule):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {}
    for r in token_counts.section_tokens(docs, token_counts.default_ranks(), rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.n_chars, round(r.n_tokens, 9), r.doc_tokens))
    for doc, text in enumerate(TEXTS):
        lines, at = [], 0
        for line in text.splitlines(keepends=True) if "\r" not in text else ["a\r\n", "b"]:
            lines.append((at, at + len(line)))
            at += len(line)
        lines = lines or [(0, 0)]
        counts, outside = brute_force(text, lines, rule)
        assert outside == 0
        total = len(token_counts.encoding(token_counts.default_ranks())[0].encode_ordinary(text))
        expected = [(i, a, b - a, round(c, 9), total) for i, ((a, b), c) in enumerate(zip(lines, counts, strict=True))]
        assert sorted(got[doc]) == expected
        assert abs(sum(c for *_, c, _ in got[doc]) - total) < 1e-6


def test_given_sections(spark):
    text = "title here body of the document goes on"
    spans = [(0, 7), (11, 20), (20, 200)]
    docs = spark.createDataFrame([(1, text, spans), (2, None, None)], "doc_id long, text string, sections array<struct<start:int,end:int>>")
    for rule in token_counts.RULES:
        rows = token_counts.section_tokens(docs, token_counts.default_ranks(), rule).collect()
        got = {r.section: r.n_tokens for r in rows if r.doc_id == 1}
        counts, outside = brute_force(text, spans, rule)
        assert [round(got[i], 9) for i in range(3)] == [round(c, 9) for c in counts]
        assert round(got.get(-1, 0), 9) == round(outside, 9)
        assert [r for r in rows if r.doc_id == 2] == []


def test_odd_rows(spark, frame, odd_rows):
    rows = token_counts.section_tokens(frame(odd_rows), token_counts.default_ranks())
    assert rows.where("section = 0").count() == len(odd_rows)
    assert rows.agg(F.sum("n_chars")).first()[0] == sum(len(t or "") for _, t in odd_rows)
    assert token_counts.section_tokens(frame([]), token_counts.default_ranks()).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_tokens(frame([]), token_counts.default_ranks(), "any")
