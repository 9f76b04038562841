import re

import xxhash
from pyspark.sql import functions as F

from shelfline.llm import fingerprints as fp


def spark_hash(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed


def brute_force(text):
    """(hash, position) of the smallest of every window, the rightmost of equals."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return []
    if len(words) < fp.GRAM:
        return [(spark_hash([" ".join(words)]) & 0x7FFFFFFF, 0)]
    grams = [spark_hash(words[i : i + fp.GRAM]) & 0x7FFFFFFF for i in range(len(words) - fp.GRAM + 1)]
    found = []
    for i in range(max(1, len(grams) - fp.WINDOW + 1)):
        window = grams[i : i + fp.WINDOW]
        at = max(j for j, h in enumerate(window) if h == min(window)) + i
        if (grams[at], at) not in found:
            found.append((grams[at], at))
    return found


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_same_as_windows_one_by_one(spark, frame, words):
    rows = [(i * 700, " ".join(words(i, n))) for i, n in enumerate([1, 2, 3, 4, 9, 10, 11, 40, 200, 500])]
    rows += [(5, None), (6, ""), (7, " \n"), (8, "be " * 60), (9, rows[8][1]), (10, "é ü\x1c x 日本 語 b c d e f g"), (10**12, "far away id")]
    text = dict(rows)
    got = {r.doc_id: r for r in fp.compared(frame(rows).repartition(3)).collect()}
    order = sorted(text, reverse=True)
    assert sorted(got) == sorted(text)
    for i, doc in enumerate(order):
        own, following = text[doc] or "", text[order[(i + 1) % len(order)]] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        r = got[doc]
        assert [(x.hash, x.position) for x in r.fingerprint] == brute_force(own)
        assert [(x.hash, x.position) for x in r.edited_fingerprint] == brute_force(changed)
        assert (r.n_chars, r.edited) == (len(own), changed)
        assert abs(r.near_edited - likeness(brute_force(own), brute_force(changed))) < 1e-12
        assert abs(r.near_next - likeness(brute_force(own), brute_force(following))) < 1e-12


def test_next_document_however_ids_are_spread(spark):
    import random

    rng = random.Random(3)
    hashed = [rng.getrandbits(63) - (1 << 62) for _ in range(300)]
    for ids, bits in ((range(3000), 10), (hashed, 50), ([*range(2000), *hashed], 10), ([7], 10), ([i << 20 for i in range(500)], 29)):
        docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(3)
        assert abs(fp.block_bits(docs) - bits) <= 18 and (bits > 10 or fp.block_bits(docs) == 10)
        rows = fp.with_next(docs.withColumn("fingerprint", F.array(F.col("doc_id")))).collect()
        order = sorted(ids, reverse=True)
        following = dict(zip(order, [*order[1:], order[0]], strict=True))
        assert {r.doc_id: r.next_text for r in rows} == {i: f"t{n}" for i, n in following.items()}
        assert len(rows) == len(order)


def test_match_guarantee(spark, words):
    shared = words(1, fp.GRAM + fp.WINDOW - 1)
    rows = [(i, " ".join(words(10 + i, 50) + shared + words(50 + i, 30))) for i in range(20)]
    docs = fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    prints = [{x.hash for x in r.fingerprint} for r in docs.collect()]
    assert all(a & b for a in prints for b in prints)


def test_odd_rows_and_plan(spark, frame, odd_rows):
    assert fp.compared(frame(odd_rows)).count() == len(odd_rows)
    assert fp.compared(frame([])).count() == 0
    one = fp.compared(frame([(1, "only one document here")])).first()
    assert one.edited == "only one doonly one do" and one.near_next == 1.0
    plan = fp.compared(frame(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert fp.as_string(F.col("x")) is not None
