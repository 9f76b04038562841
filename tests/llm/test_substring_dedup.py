import re

from shelfline.llm import substring_dedup as sub


def brute_force(rows, least):
    """(doc, start, n_chars) of rows of repeated units."""
    seen, out = set(), []
    for doc, text in sorted(rows):
        text = text or ""
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        units = []
        for k, (a, _, w) in enumerate(words):
            fresh = not k or words[k - 1][2][-1] in ".!?" or "\n" in text[words[k - 1][1] : a]
            if fresh:
                units.append([a, []])
            units[-1][1].append(re.sub("[A-Z]", lambda m: m[0].lower(), w))
        stops = [u[0] for u in units[1:]] + [len(text)] * bool(units)
        run = None
        for (a, own), b in zip(units, stops, strict=True):
            again = tuple(own) in seen
            seen.add(tuple(own))
            if again:
                run = (run[0], b) if run else (a, b)
            if not again and run:
                out.append((doc, run[0], run[1] - run[0]))
                run = None
        if run:
            out.append((doc, run[0], run[1] - run[0]))
    return sorted(x for x in out if x[2] >= least)


def test_same_as_one_by_one(spark, frame, words):
    def sentences(seed, n):
        return [" ".join(words(seed * 100 + i, 6 + i % 7)).capitalize() + ".!?"[i % 3] for i in range(n)]

    passage = "  ".join(sentences(1, 8))
    rows = [(i, " ".join(sentences(10 + i, 6)) + ("\n" if i % 2 else " ") + (passage if i % 3 else "Of. Of.") + " " + " ".join(sentences(40 + i, 4))) for i in range(24)]
    rows += [(50, "Lizenz: tue was du willst.\n" * 30), (51, "été ü " + passage.upper()), (52, None), (53, " \n\t"), (54, "x")]
    docs = frame(rows).repartition(3)
    got = sub.repeated_units(spark, docs)
    assert sorted((r.doc_id, r.start_char, r.n_chars) for r in got.collect()) == brute_force(rows, sub.MIN_CHARS)
    left = {r.doc_id: r.text for r in sub.cut_units(spark, docs).collect()}
    for doc, original in rows:
        at, kept = 0, ""
        for _, start, n in (c for c in brute_force(rows, sub.MIN_CHARS) if c[0] == doc):
            kept, at = kept + original[at:start], start + n
        assert left[doc] == (None if original is None else kept + original[at:])


def test_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    assert sub.repeated_units(spark, docs).count() == 0
    assert sub.cut_units(spark, docs).columns == docs.columns
    assert sub.cut_units(spark, docs).count() == len(odd_rows)
    assert sub.repeated_units(spark, frame([])).count() == 0


def test_short_lines_between_others(spark, frame, words):
    """Every later occurrence of a whole line goes, however short; a short sentence in a line stays."""
    boiler = ["Home | About us | Contact", "All rights reserved. No warranty. Ask.", "}"]
    rows = [(0, "Before it. Yes. Behind it."), (1, f"{boiler[1]} Yes."), (2, "é " + boiler[1])]
    for i in range(3, 30):
        own = [" ".join(words(3000 + 10 * i + j, 9)) for j in range(4)]
        lines = [own[0], boiler[i % 2].upper(), own[1] + " Yes.", boiler[2], "  " + boiler[1 - i % 2], "", own[2], "Yes."]
        rows.append((i, "\n".join(lines[: 5 + i % 4])))
    seen, expected = set(), {}
    for doc, text in sorted(rows):
        at = 0
        for line in text.splitlines(keepends=True):
            key = tuple(line.lower().split())
            if key in seen:
                expected.setdefault(doc, set()).update(at + j for j, c in enumerate(line) if not c.isspace())
            seen |= {key} - {()}
            at += len(line)
    docs = frame(rows).repartition(3)
    got, text = {}, dict(rows)
    for r in sub.repeated_units(spark, docs).collect():
        span = range(r.start_char, r.start_char + r.n_chars)
        assert not got.get(r.doc_id, set()) & set(span)
        got.setdefault(r.doc_id, set()).update(j for j in span if not text[r.doc_id][j].isspace())
        line = text[r.doc_id][r.start_char :].split("\n")[0].strip().lower()
        assert text[r.keep_doc_id][r.keep_start_char :].split("\n")[0].strip().lower() == line
    assert len(expected) > 20
    assert got == expected
    left = {r.doc_id: r.text for r in sub.cut_units(spark, docs).collect()}
    for doc, original in rows:
        assert "".join(left[doc].split()) == "".join(c for j, c in enumerate(original) if j not in expected.get(doc, ()) and not c.isspace())
