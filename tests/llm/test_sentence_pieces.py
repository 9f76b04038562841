import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import sentence_pieces as sp

CODEC = sp.codec(sp.default_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=sp.default_model())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcdeinorstTHE .,\n\t  éß日本😀1")), max_size=60))
def test_ids_are_the_librarys(text):
    ids = CODEC.encode([text])[0]
    assert ids.tolist() == LIBRARY.encode(text)
    assert CODEC.decode(ids) == text


def test_long_and_repetitive():
    texts = ["x" * 300 + "y", "ab" * 400, "é" * 3000, "    " * 40 + "z", "the " * 50, " ", "   ", ""]
    for text, ids in zip(texts, CODEC.encode(texts), strict=True):
        assert ids.tolist() == LIBRARY.encode(text)


def test_unigram_scores_take_the_largest_sum():
    pieces = {0: "a", 1: "b", 2: "ab", 3: "ba", 4: "aba", 5: sp.MARK}
    scores = {0: -1.5, 1: -1.5, 2: -2.0, 3: -1.2, 4: -5.0, 5: -0.5}
    own = sp.PieceCodec(pieces, scores, list(range(100, 356)), merges=False)
    best = {}

    def total(word):
        if not word:
            return 0.0, ()
        if word not in best:
            ways = [(scores[i] + total(word[len(p) :])[0], (i, *total(word[len(p) :])[1])) for i, p in pieces.items() if word.startswith(p)]
            best[word] = max(ways)
        return best[word]

    texts = ["abba", "ababa", "baab", "aabbab abab"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        got = sum(scores[i] for i in ids.tolist())
        assert abs(got - total(sp.MARK + text.replace(" ", sp.MARK))[0]) < 1e-9
        assert own.decode(ids) == text


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(sp, "WORDS_KNOWN", 50)
    own = sp.PieceCodec.load(sp.default_model())
    for i in range(20):
        texts = [f"word{i} and{i * j}" for j in range(30)]
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert ids.tolist() == LIBRARY.encode(text)


def test_round_trip(spark, frame, odd_rows):
    docs = frame(odd_rows)
    ids = sp.encoded(docs, sp.default_model())
    expected = sorted(((str(d), LIBRARY.encode(t or "")) for d, t in odd_rows), key=str)
    assert sorted(((str(r.doc_id), r.ids) for r in ids.collect()), key=str) == expected
    back = sp.decoded(ids, sp.default_model())
    assert sorted(((str(r.doc_id), r.text) for r in back.collect())) == sorted((str(d), t or "") for d, t in odd_rows)
    assert sp.round_trips(docs, sp.default_model()).where("round_trip").count() == len(odd_rows)
    assert sp.encoded(frame([]), sp.default_model()).count() == 0
    assert np.uint16(CODEC.ids.max()) == CODEC.ids.max()
