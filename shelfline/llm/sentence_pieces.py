"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

Texts fall into words at the marks that stand for spaces (no piece goes on behind its
first mark), distinct unknown words are collected, and words of equal length advance
together: for every end and every piece length the hashes of all words' substrings probe
the sorted hashes of the pieces, and the best way to each end is stored with a
backpointer, for all words in one step.

What is best depends on the model:

* unigram models: the largest sum of piece scores;
* merge models (BPE, like the public one here): a sum of scores does not give their
  encoding, so the search is of first order. A piece may follow another one only if
  merging would have left a border between the two; the maximum is taken over such pieces.
  That needs no replay of merges: undoing the merges of both pieces, the latest first,
  shows whether a merge across the border would have come first. Answers are kept per pair.

Characters that no piece has become UTF-8 byte pieces. Decoding joins the bytes of the pieces.

Cases: null and empty texts have no ids. A word of any length is encoded whole; it is
parted only between characters that no piece holds side by side. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.words import inverse_powers, mix, powers, slices

MARK = "▁"
#: Words that a worker remembers in each of two generations; when the younger one is full, the older one is forgotten.
WORDS_KNOWN = 250_000
#: Words that advance together.
TOGETHER = 20_000
_FILTER_BITS = 22
#: Slots for answers on pairs of pieces; a newer pair takes the place of an older one.
_PAIR_BITS = 21
_UNKNOWN = 60_000  # stands for a character without a piece, until its bytes replace it

_codecs: dict[str, "PieceCodec"] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def codec(path: str) -> "PieceCodec":
    if path not in _codecs:
        _codecs[path] = PieceCodec.load(path)
    return _codecs[path]


def _hash_all(strings: list[str]) -> np.ndarray:
    """Hash of each string, by the same rule as the substrings of words."""
    found = np.zeros(len(strings), np.uint64)
    for i, s in enumerate(strings):
        codes = np.array([ord(c) for c in s], np.uint64) + np.uint64(1)
        found[i] = (mix(codes) * powers(len(codes))).sum(dtype=np.uint64)
    return found


class PieceCodec:
    """Pieces of a model with their scores; ``byte_ids`` are the 256 byte pieces."""

    def __init__(self, pieces: dict[int, str], scores: dict[int, float], byte_ids: list[int], merges: bool):
        self.merges = merges
        self.byte_ids = byte_ids
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        ids = np.array(sorted(pieces), np.int64)
        texts = [pieces[i] for i in ids]
        hashes = _hash_all(texts)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("piece hashes collide")
        # most substrings are no pieces: their leading bits tell so before the search
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.score = np.zeros(_UNKNOWN + 1)
        self.score[ids] = [scores[i] for i in ids]
        self.score[_UNKNOWN] = min(scores.values(), default=0.0) - 10
        self.sizes = np.ones(_UNKNOWN + 1, np.int64)
        self.sizes[ids] = [len(t) for t in texts]
        self.longest = max(map(len, texts), default=1)
        self.beside = {t[k : k + 2] for t in texts for k in range(len(t) - 1)}
        self.bytes_of: dict[int, bytes] = {i: t.replace(MARK, " ").encode() for i, t in pieces.items()}
        self.bytes_of |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        if merges:
            self._prepare_merges(pieces, scores)

    @classmethod
    def load(cls, path: str) -> "PieceCodec":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        pieces = {i: model.id_to_piece(i) for i in usual}
        for i, t in pieces.items():
            if MARK in t.lstrip(MARK):
                raise ValueError(f"piece {i} goes on behind a mark")
        scores = {i: model.get_score(i) for i in usual}
        # scores of merge models are the negative numbers of their merges
        merges = all(float(s).is_integer() for s in scores.values())
        return cls(pieces, scores, byte_ids, merges)

    def _prepare_merges(self, pieces: dict[int, str], scores: dict[int, float]) -> None:
        named = {t: i for i, t in pieces.items()}
        # order of merges; single characters are given, not merged
        self.rank = np.full(_UNKNOWN + 1, -1, np.int64)
        several = sorted((i for i, t in pieces.items() if len(t) > 1), key=lambda i: (-scores[i], i))
        self.rank[several] = np.arange(len(several))
        pairs = {}
        for t, i in named.items():
            for k in range(1, len(t)):
                a, b = named.get(t[:k]), named.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 16 | b] = i
        self.pair_codes = np.array(sorted(pairs), np.int64)
        self.pair_ids = np.array([pairs[c] for c in self.pair_codes], np.int64)
        # the last merge that makes each piece, by merging its own characters
        self.left = np.arange(_UNKNOWN + 1)
        self.right = np.arange(_UNKNOWN + 1)
        self.made = np.ones(_UNKNOWN + 1, bool)
        for i in several:
            parts = [named.get(c, _UNKNOWN) for c in pieces[i]]
            while len(parts) > 2:
                options = [(self.rank[m], k, m) for k in range(len(parts) - 1) if (m := pairs.get(parts[k] << 16 | parts[k + 1])) is not None]
                if not options:
                    break
                _, k, m = min(options)
                parts[k : k + 2] = [m]
            self.made[i] = len(parts) == 2 and pairs.get(parts[0] << 16 | parts[1]) == i
            if self.made[i]:
                self.left[i], self.right[i] = parts
        self.known_codes = np.full(1 << _PAIR_BITS, -1, np.int64)
        self.known = np.zeros(1 << _PAIR_BITS, bool)

    def _border_stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of a + b ends in a and b, for pairs of pieces."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        stays = self.made[a] & self.made[b]
        at = np.flatnonzero(stays)
        while len(at):
            x, y = a[at], b[at]
            code = x << 16 | y
            k = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
            merged = self.pair_codes[k] == code if len(self.pair_codes) else np.zeros(len(at), bool)
            across = np.where(merged, self.rank[self.pair_ids[k]], np.iinfo(np.int64).max) if len(self.pair_codes) else limit[at]
            lost = across < limit[at]
            stays[at[lost]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~lost & ((rx >= 0) | (ry >= 0))
            at, x, y, rx, ry = at[go], x[go], y[go], rx[go], ry[go]
            # of equal merges the left one comes first, so the right one is undone first
            undo_left = rx > ry
            limit[at] = np.where(undo_left, rx, ry + 1)
            a[at] = np.where(undo_left, self.right[x], x)
            b[at] = np.where(undo_left, y, self.left[y])
        return stays

    def _may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        codes = a << 16 | b
        slots = (mix(codes.astype(np.uint64)) >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)
        answers = self.known[slots]
        new = np.flatnonzero(self.known_codes[slots] != codes)
        if len(new):
            fresh, back = np.unique(codes[new], return_inverse=True)
            answers[new] = self._border_stays(fresh >> 16, fresh & 0xFFFF)[back]
            self.known_codes[slots[new]] = codes[new]
            # two new pairs may want one slot: the answer must be that of the pair which got it
            kept = new[self.known_codes[slots[new]] == codes[new]]
            self.known[slots[kept]] = answers[kept]
        return answers

    def _pieces_in(self, sums: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
        """End, word, size and id of every substring that is a piece, by end; single characters always are."""
        inverse = inverse_powers(n)
        ends, rows, sizes, ids = [], [], [], []
        for size in range(1, min(n, self.longest) + 1):
            probe = (sums[size:] - sums[:-size]) * inverse[: n - size + 1, None]
            hit = self.maybe[(probe >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
            end, row = np.nonzero(hit if size > 1 else np.ones_like(hit))
            value = probe[end, row]
            k = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
            is_piece = self.hashes[k] == value
            found = np.where(is_piece, self.ids[k], _UNKNOWN)
            if size > 1:
                end, row, found = end[is_piece], row[is_piece], found[is_piece]
            ends.append(end + size)
            rows.append(row)
            sizes.append(np.full(len(end), size))
            ids.append(found)
        ends, rows, sizes, ids = (np.concatenate(x) for x in (ends, rows, sizes, ids))
        order = np.argsort(ends, kind="stable")
        return ends[order], rows[order], sizes[order], ids[order]

    def _search(self, words: np.ndarray) -> list[bytes]:
        """Ids of words of equal length, given as rows of code points."""
        m, n = words.shape
        values = mix(words.astype(np.uint64) + np.uint64(1)) * powers(n)[None]
        sums = np.zeros((n + 1, m), np.uint64)
        np.cumsum(values.T, axis=0, out=sums[1:])
        ends, rows, sizes, ids = self._pieces_in(sums, n)
        at = np.searchsorted(ends, np.arange(1, n + 2))
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        piece = np.full((n + 1, m), -1, np.int64)
        for end in range(1, n + 1):
            row, size, found = (x[at[end - 1] : at[end]] for x in (rows, sizes, ids))
            begin = end - size
            open_way = best[begin, row] > -np.inf
            if self.merges:
                behind = np.flatnonzero(open_way & (begin > 0))
                open_way[behind] = self._may_follow(piece[begin[behind], row[behind]], found[behind])
            row, begin, found = row[open_way], begin[open_way], found[open_way]
            total = self.score[found] + (0 if self.merges else best[begin, row])
            order = np.argsort(total, kind="stable")  # of several for one word the last is stored, which is the best
            best[end, row[order]] = total[order]
            piece[end, row[order]] = found[order]
        return self._trace(words, piece)

    def _trace(self, words: np.ndarray, piece: np.ndarray) -> list[bytes]:
        n, m = len(piece) - 1, piece.shape[1]
        sizes = self.sizes
        at, out = np.full(m, n), np.full((n, m), -1, np.int64)
        for step in range(n):  # from the ends back, all words at once
            live = np.flatnonzero(at > 0)
            if not len(live):
                break
            out[step, live] = piece[at[live], live]
            at[live] -= sizes[out[step, live]]
        # steps run backwards, so the last ones come first in each word's row
        rows = out[::-1].T
        ids = rows[rows >= 0]
        ends = np.cumsum((rows >= 0).sum(axis=1))
        raw, cuts = ids.astype(np.uint16).tobytes(), (2 * np.r_[0, ends]).tolist()
        found = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(ids == _UNKNOWN), side="right"))
        for j in odd.tolist():  # characters without a piece become their bytes
            place, own = 0, []
            for i in ids[cuts[j] // 2 : cuts[j + 1] // 2].tolist():
                if i == _UNKNOWN:
                    own += [self.byte_ids[b] for b in chr(words[j, place]).encode()]
                else:
                    own.append(i)
                place += sizes[i]
            found[j] = np.array(own, np.uint16).tobytes()
        return found

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet."""
        by_length: dict[int, set[str]] = defaultdict(set)
        parts_of = {}
        for w in words:
            parts = self._parts(w) if len(w) > 24 else [w]
            if len(parts) > 1:
                parts_of[w] = parts
            for p in parts:
                by_length[len(p)].add(p)
        own: dict[str, bytes] = {}
        for n, group in by_length.items():
            some = list(group)
            together = max(1, min(TOGETHER, (1 << 22) // n))
            for i in range(0, len(some), together):
                part = some[i : i + together]
                points = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), n)
                own.update(zip(part, self._search(points), strict=True))
        for w in words:
            self.words[w] = b"".join(own[p] for p in parts_of[w]) if w in parts_of else own[w]

    def _parts(self, word: str) -> list[str]:
        """A long word, parted between characters that no piece holds side by side."""
        cuts = [k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.beside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)]

    @staticmethod
    def split(text: str) -> list[str]:
        """Words with the marks before them; a mark for the text's begin is put in front."""
        if not text:
            return []
        words = (MARK + text.replace(" ", MARK)).split(MARK)
        # words[0] is empty; each empty word further on is a mark of the word after it
        out, marks = [], ""
        for w in words[1:]:
            marks += MARK
            if w:
                out.append(marks + w)
                marks = ""
        return [*out, marks] if marks else out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.split(t or "") for t in texts]
        if len(self.words) > WORDS_KNOWN:  # what is still in use comes back from the older generation
            self.words, self.older = {}, self.words
        words, older, missing = self.words, self.older, []
        for w in set().union(*split).difference(words):
            ids = older.get(w)
            if ids is None:
                missing.append(w)
            else:
                words[w] = ids
        if missing:
            self.learn(missing)
        get = self.words.__getitem__
        return [np.frombuffer(b"".join(map(get, s)), np.uint16) for s in split]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the mark that was put in front goes."""
        text = b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in slices(batches, most=1 << 22):
            ids = own.encode(batch.column("text").to_pylist())
            arrays = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)), pa.array(np.concatenate(ids).astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), arrays], names=["doc_id", "ids"])

    return run


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [own.decode(np.array(i if i is not None else [], np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids of every row of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode(model), "doc_id long, ids array<int>")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every row of ``ids`` (doc_id, ids); null ids are an empty text."""
    return ids.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(_decode(model), "doc_id long, text string")


def round_trips(docs: DataFrame, model: str) -> DataFrame:
    """Per row: n_ids, ids_crc32 (ids as unsigned little-endian 32-bit numbers), and whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in slices(batches, most=1 << 22):
            texts = batch.column("text").to_pylist()
            ids = own.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                    pa.array([own.decode(i) == (t or "") for i, t in zip(ids, texts, strict=True)]),
                ],
                names=["doc_id", "n_ids", "ids_crc32", "round_trip"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean"
    )
