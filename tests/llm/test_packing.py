import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfline.llm import packing

MEMORY = packing.WordMemory(packing.default_tokenizer())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abAB.,' \t\n\x0b\x1c\x85\xa0éÉ1½Σßİŉǰͅα'́一😀<|>")), max_size=40))
def test_ids_are_the_tokenizers(text):
    expected = MEMORY.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(MEMORY.encode([text])[0], np.uint16).tolist() == expected


def test_special_strings():
    for text in ["<|endoftext|> a", "<|ENDOFTEXT|>", "x<|startoftext|>y", "don't we'LL .. ., ,,"]:
        expected = MEMORY.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(MEMORY.encode([text])[0], np.uint16).tolist() == expected


def plain_best_fit(lengths, size, most_open):
    """The same rule over a plain list of (free space, number)."""
    bins, out, made = [], [], 0
    for need in lengths:
        fits = [b for b in bins if b[0] >= need]
        if fits:
            least = min(b[0] for b in fits)
            own = [b for b in fits if b[0] == least][-1]
            bins.remove(own)
        else:
            if len(bins) == most_open:
                bins.remove([b for b in bins if b[0] == min(x[0] for x in bins)][-1])
            own, made = (size, made), made + 1
        out.append((own[1], size - own[0]))
        if own[0] > need:
            bins.append((own[0] - need, own[1]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80), st.integers(1, 6), st.integers(1, 80))
def test_best_fit(lengths, most_open, cut):
    packer = packing.Packer(30, most_open)
    parts = [packer.add(np.array(x, np.int64)) for x in (lengths[:cut], lengths[cut:])]
    places, offsets = (np.concatenate(x).tolist() for x in zip(*parts, strict=True))
    assert list(zip(places, offsets, strict=True)) == plain_best_fit(lengths, 30, most_open)


def test_many_pieces_fill_their_sequences():
    """100,000 pieces, with bins closed on the way, stay within one per cent of the lower bound."""
    rng = np.random.default_rng(1)
    lengths = np.minimum(2048, (rng.pareto(1.1, 100_000) * 150 + 5).astype(np.int64))
    for some in (lengths, np.sort(lengths), np.sort(lengths)[::-1], rng.integers(1, 2049, 100_000)):
        packer = packing.Packer()
        parts = [packer.add_runs(some[i : i + 10_000]) for i in range(0, len(some), 10_000)]
        places, offsets = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((offsets, places))
        begins = np.r_[True, np.diff(places[order]) != 0]
        ends = (offsets + some)[order]
        assert (offsets[order][begins] == 0).all() and (offsets[order][1:][~begins[1:]] == ends[:-1][~begins[1:]]).all()
        assert ends.max() <= 2048 and packer.n_open <= packing.OPEN_BINS
        if not (np.diff(some) >= 0).all() and not (np.diff(some) <= 0).all():
            assert packer.made <= 1.01 * -(-some.sum() // 2048) or packer.made <= 1.01 * plain_bound(some)


def plain_bound(lengths):
    """Sequences that are needed in any case: pieces of more than half a sequence take one each."""
    return max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()))


def test_words_come_back_from_the_older_generation(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KNOWN", 3)
    memory = packing.WordMemory(packing.default_tokenizer())
    texts = ["one two. three, 12. a-. four", "one five, six. seven eight 12.", "nine two ten. a-. one, 12,", "eleven twelve. one two three"] * 3
    for text in texts:
        expected = memory.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(memory.encode([text])[0], np.uint16).tolist() == expected


def test_packed(spark, frame, odd_rows):
    rows = odd_rows + [(1000 + i, "word " * (i * 7 % 300)) for i in range(300)]
    got = packing.packed(spark, frame(rows).repartition(4), packing.default_tokenizer()).collect()
    library = Tokenizer.from_file(packing.default_tokenizer())
    expected, total = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.append((str(doc), piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r["offset"])):
        assert r["offset"] == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r["offset"] + r.length
    assert max(at.values()) <= 2048
    assert len(at) <= total / 2048 + 2
    assert packing.packed(spark, frame([]), packing.default_tokenizer()).count() == 0
