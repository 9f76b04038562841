import random

import numpy as np
import pyarrow as pa

from shelfline.llm import suffix_dedup

N = 50


def brute_force(rows, n=N):
    """Word places that lie in a passage of n words which a document with a smaller id holds."""
    seen, covered = {}, {}
    for doc, text in sorted(rows):
        words = (text or "").split()
        own = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        covered[doc] = {j for i, w in enumerate(own) if w in seen for j in range(i, i + n)}
        for w in own:
            seen.setdefault(w, doc)
    return {d: c for d, c in covered.items() if c}


def texts(words):
    rng = random.Random(5)
    rows, passages = [], [words(900 + i, 50 + 7 * i) for i in range(8)]
    for doc in range(60):
        body = words(doc, 80 + rng.randrange(200))
        for _ in range(doc % 3):
            at = rng.randrange(len(body))
            body[at:at] = rng.choice(passages)
        rows.append((doc, " ".join(body)))
    rows += [(100, " ".join(words(3, 200))), (101, " ".join(words(3, 200))), (102, "be " * 300), (103, "be " * 200)]
    rows += [(110, " ".join(words(777, 49))), (111, " ".join(words(777, 49)) + " x")]
    return rows


def places(spans):
    found = {}
    for r in spans:
        found.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    return found


def test_same_as_all_windows(spark, words):
    rows = texts(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = suffix_dedup.repeated_passages(spark, docs).collect()
    got, expected, loose = places(spans), brute_force(rows), brute_force(rows, suffix_dedup.SEED)
    assert set(got) >= set(expected)
    for doc, own in got.items():
        # nothing is missed; what comes on top are shorter repeats that touch each other
        assert own >= expected.get(doc, set())
        assert own <= loose[doc]
    assert sum(got[d] == expected.get(d) for d in got) > 0.9 * len(got)
    assert all(r.n_words >= N for r in spans)
    text = dict(rows)
    for r in spans:
        cut = text[r.doc_id][r.start_char : r.start_char + r.n_chars].split()
        assert cut == text[r.doc_id].split()[r.start_word : r.start_word + r.n_words]


def test_cut_and_odd_rows(spark, frame, odd_rows, words):
    passage = " ".join(words(5, 60))
    rows = odd_rows + [(200, f"été  {passage}\n\ttail"), (201, f"head ü {passage} end"), (202, passage), (6, odd_rows[8][1])]
    docs = frame(rows)
    left = suffix_dedup.cut_repeats(spark, docs)
    assert left.columns == docs.columns
    got = [(r.doc_id, r.text) for r in left.select("doc_id", "text").collect()]
    expected = [(d, t) for d, t in rows if d not in (201, 202)] + [(201, "head ü  end")]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert suffix_dedup.repeated_passages(spark, frame([])).count() == 0


def test_several_texts_under_one_id(spark, words):
    """Texts of different lengths share a doc_id; each is cut by its own repeats, and none by those of the other rows."""
    one, two, three = words(1, 60), words(2, 70), words(3, 55)
    pads = [words(100 + i, 40) for i in range(9)]
    rows = [
        (5, " ".join([*pads[0], *one])),
        (5, " ".join(pads[1][:20])),
        (5, " ".join([*pads[2], *pads[3], *two])),
        (9, " ".join([*pads[4], *one, *pads[5], *two])),
        (9, " ".join([*pads[6], *three])),
        (9, " ".join([*pads[7], *pads[8], *three, "end"])),
        (12, " ".join([*three, *words(300, 40)])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = {(r.doc_id, r.start_word, r.n_words) for r in suffix_dedup.repeated_passages(spark, docs).collect()}
    assert spans == {(9, 40, 60), (9, 140, 70), (12, 0, 55)}
    left = {(r.doc_id, len(r.text.split())) for r in suffix_dedup.cut_repeats(spark, docs).collect()}
    assert left == {(5, 100), (5, 20), (5, 150), (9, 80), (9, 95), (9, 136), (12, 40)}


def test_first_occurrence_holds_only_a_piece(spark, words):
    """Earlier documents, or earlier places of one, hold 40 words of the 55 to 90 that later documents share."""
    rows = []
    for k in range(12):
        passage, doc = words(2000 + k, 55 + 3 * k), 1000 * k
        at = (0, len(passage) - 40, 8)[k % 3]
        piece = passage[at : at + 40]
        pad = [words(5000 + 20 * k + i, 30) for i in range(8)]
        first = [*pad[0], *piece, *pad[1]]
        rows.append((doc, " ".join(first)))
        # every other first document holds the whole passage as well, behind the piece
        if k % 2:
            rows[-1] = (doc, " ".join([*first, *passage, *pad[2]]))
        rows += [(doc + 1 + i, " ".join([*pad[3 + i], *passage, *pad[5 + i]])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spans = suffix_dedup.repeated_passages(spark, docs).collect()
    got, expected = places(spans), brute_force(rows)
    assert len(expected) == 18
    assert got == expected
    text = {d: t.split() for d, t in rows}
    for r in spans:
        assert text[r.doc_id][r.start_word : r.start_word + r.n_words] == text[r.match_doc_id][r.match_start_word : r.match_start_word + r.n_words]
        assert " ".join(text[r.doc_id])[r.start_char : r.start_char + r.n_chars].split() == text[r.doc_id][r.start_word : r.start_word + r.n_words]


def test_runs_of_one_word_travel_together(spark, words, monkeypatch):
    """A run of one word matches the same occurrence at each of its places, which is one row for up to PLACES of them."""
    rows = [(i, " ".join([*words(50 + i, 40), *["be"] * (150 + 10 * i), *words(80 + i, 45)])) for i in range(6)]
    kept = {}

    def stored(spark, df, root, name, write=suffix_dedup.stored):
        kept[name] = write(spark, df, root, name)
        return kept[name]

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = suffix_dedup.repeated_passages(spark, docs).collect()
    hits = kept["hits"].where("doc_id <> lead_doc").count()
    matches = kept["matches"].where(f"kind = {suffix_dedup.MATCH}").count()
    assert hits > 600
    assert matches <= hits // suffix_dedup.PLACES + 5
    assert places(spans) == brute_force(rows)


def test_texts_that_go_round_are_sorted_in_few_rows(spark, words, monkeypatch):
    """The suffixes, and the stretches over borders, of a text that goes round in one or two words are few rows, and nothing found is lost."""
    rows = []
    for i in range(8):
        rounds = ["be"] * (300 + 10 * i) if i % 2 else ["to", "be"] * (150 + 5 * i)
        rows.append((i, " ".join([*words(50 + i, 40), *rounds, *words(80 + i, 45)])))
    kept = {}

    def stored(spark, df, root, name, write=suffix_dedup.stored):
        kept[name] = write(spark, df, root, name)
        return kept[name]

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    spans = suffix_dedup.repeated_passages(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert kept["runs"].count() < 100
    assert kept["stretches"].count() < 100
    assert places(spans) == brute_force(rows)
    for r in spans:
        cut = dict(rows)[r.doc_id][r.start_char : r.start_char + r.n_chars].split()
        assert cut == dict(rows)[r.doc_id].split()[r.start_word : r.start_word + r.n_words]


def test_places_of_one_row_stay_in_one_row():
    """Places that one occurrence matches are extended each by itself, and leave in the row in which they came."""
    reach, seed = suffix_dedup.REACH, suffix_dedup.SEED
    same, other = np.zeros(reach, np.uint32), np.ones(reach, np.uint32)
    beyond = np.arange(reach + 1)
    places = [30, 31, 90]
    row = {
        "doc_id": 7,
        "tag": 1,
        "places": places,
        "lead_doc": 3,
        "lead_first": 40,
        "lead_last": 50,
        "left": b"".join(x.tobytes() for x in (same, np.r_[same[:2], other[2:]], other)),
        "right": b"".join(x.tobytes() for x in (other, other, same)),
        "lead_left": same.tobytes(),
        "lead_right": same.tobytes(),
        "char_starts": [2 * x for p in places for x in (p - beyond).tolist()],
        "char_ends": [2 * x for p in places for x in (p + 10 + seed + beyond).tolist()],
    }
    out = [r for b in suffix_dedup._extend(iter([pa.RecordBatch.from_pylist([row])])) for r in b.to_pylist()]
    assert len(out) == 1
    found = [(x["start"], x["end"], x["char_start"], x["char_end"], x["match_doc_id"], x["match_start"]) for x in out[0]["spans"]]
    ends = [30 + 10 + seed, 31 + 10 + seed, 90 + 10 + seed + reach]
    starts = [30 - reach, 29, 90]
    assert found == [(s, e, 2 * s, 2 * e, 3, 40 - p + s) for p, s, e in zip(places, starts, ends)]


def test_stretches_are_those_of_a_plain_rule():
    """Spans of the same shift that touch are one match; matches that touch are one stretch, named by its longest match."""
    rng = random.Random(8)
    docs = [
        [(s, s + rng.randrange(20, 60), rng.randrange(3), s + rng.choice((-5, 0, 3))) for s in (rng.randrange(900) for _ in range(rng.randrange(1, 25)))]
        for _ in range(80)
    ]

    def joined(spans):
        found = []
        for s in sorted(spans):
            if found and found[-1][1] >= s[0]:
                found[-1] = (found[-1][0], max(found[-1][1], s[1]), found[-1][2] + s[2])
            else:
                found.append(s)
        return found

    expected = []
    for doc, spans in enumerate(docs):
        matches = []
        for lead, shift in sorted({(lead, at - s) for s, _, lead, at in spans}):
            matches += [(s, e, [(e - s, -lead, -(s + shift))]) for s, e, _ in joined([(s, e, []) for s, e, k, at in spans if (k, at - s) == (lead, shift)])]
        for s, e, of in joined(matches):
            _, lead, at = max(of)
            expected += [(doc, s, e - s, 2 * s, 2 * (e - s), -lead, -at)] if e - s >= N else []
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "end", "char_start", "char_end", "match_doc_id", "match_start")]))
    rows = [[dict(start=s, end=e, char_start=2 * s, char_end=2 * e, match_doc_id=k, match_start=at) for s, e, k, at in d] for d in docs]
    batch = pa.RecordBatch.from_arrays([pa.array(range(80)), pa.array(range(80)), pa.array(rows, kind)], names=["doc_id", "tag", "spans"])
    got = [tuple(v for c, v in r.items() if c != "text_hash") for b in suffix_dedup._stretches(iter([batch]), N) for r in b.to_pylist()]
    assert sorted(got) == sorted(expected)
