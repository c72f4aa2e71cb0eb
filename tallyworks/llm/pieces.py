"""SentencePiece encoding and decoding by batched Viterbi over numpy arrays.

A text is cut into words at its spaces (no piece holds a space after another character) and at marks that no piece holds
together with other characters; a long word is cut further between characters that stand next to each other in no piece, so that a
text without spaces is no single word. Words not met before are encoded together: those of similar length advance side by side,
character by character, the shorter ones padded. At each place the substrings that end there are hashed from running sums and probed in the sorted keys of the pieces, most of them no further than
a table of flags that shows they are no key; the best piece of every word is kept by
vectorised comparison, with its length as backpointer. Backpointers are then followed from the ends.

A model file has one of two kinds of pieces, and what "best" means follows it:

- ``unigram``: the largest sum of scores, the first of equal ones having the longest last piece.
- ``bpe``: scores are ranks of merges, not log probabilities, and the segmentation of largest sum is *not* that of the model.
  Here a piece may follow another only if merging the two by rank gives just these two. A word is segmented by its merges
  exactly if all its neighbours are such pairs, and exactly one piece ends so at every place; the step of the search is a choice
  among those instead of a maximum of sums. Which pairs may follow each other is worked out once and remembered: the merges of
  either piece alone, put in the order of their ranks, must never leave a better one across their border.

Characters without a piece become the pieces of their bytes. Decoding joins pieces and gives the text back exactly, but for
the mark U+2581, which stands for a space.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import batches, mix

SPACE = "▁"
#: Words that a Python worker remembers; later ones are encoded each time they come.
REMEMBERED = 500_000
#: Characters of a word that is remembered, at most, and from which on a word is cut between characters that no piece joins.
REMEMBERED_CHARS = 64
LONG_WORD = 12
#: Pairs of pieces that it remembers, and places of the table in which those that come often are found without a loop.
REMEMBERED_PAIRS = 1_000_000
PAIR_PLACES = 1 << 20
#: Flags by which a key that no piece has is told before the sorted keys are searched.
KEY_FLAGS = 1 << 21
#: Characters of texts, and of new words, that are worked on together: the more words of a length, the fewer steps a word takes.
BATCH_CHARS = 1 << 22

_MARKS = ".,;:!?|%&$#*()\"\n"
_BASE = np.uint64(0x2545F4914F6CDD1D)
#: What the score of a character without piece is below the lowest score.
UNKNOWN_PENALTY = 10.0
_START, _UNKNOWN = -1, -2


class Pieces:
    """The pieces of a model file and the search over them."""

    def __init__(self, path: str | None, kind: str = "bpe", pieces: list[tuple[str, float]] | None = None, bytes_from: int = 0):
        """From a file, or for tests from (piece, score) with ids by position and 256 byte pieces from ``bytes_from`` on."""
        if kind not in ("bpe", "unigram"):
            raise ValueError("kind is bpe or unigram")
        self.kind = kind
        if path is None:
            found = [(i, p, s) for i, (p, s) in enumerate(pieces)]
            self.byte_id = list(range(bytes_from, bytes_from + 256))
            self.raw = [p.encode() for p, _ in pieces] + [b""] * max(0, bytes_from + 256 - len(pieces))
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            size = model.get_piece_size()
            special = [model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
            found = [(i, model.id_to_piece(i), model.get_score(i)) for i in range(size) if not special[i]]
            self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
            self.raw = [b"" if special[i] else model.id_to_piece(i).encode() for i in range(size)]
        for b, i in enumerate(self.byte_id):
            self.raw[i] = bytes([b])
        self.text = {i: p for i, p, _ in found}
        self.rank = {p: s for _, p, s in found}
        self.longest = max(len(p) for _, p, _ in found)
        keys = np.array([self._key(p) for _, p, _ in found], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for i, _, _ in found], np.int64)[order]
        self.scores = np.array([s for _, _, s in found])[order]
        self.flags = np.zeros(KEY_FLAGS, bool)
        self.flags[self.keys & np.uint64(KEY_FLAGS - 1)] = True
        self.unknown_score = self.scores.min() - UNKNOWN_PENALTY
        joined = {c for _, p, _ in found for c in _MARKS if c in p and p.strip(c)}
        alone = "".join(re.escape(c) for c in _MARKS if c not in joined)
        self.word = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|[{alone}]+" if alone else ""))
        self.joined = {p[i : i + 2] for _, p, _ in found for i in range(len(p) - 1)}
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.pair_places = np.full(PAIR_PLACES, -1, np.int64)
        self.alone: dict[int, tuple | None] = {}

    @staticmethod
    def _key(piece: str) -> np.uint64:
        total = 0
        for c in piece:
            total = (total * int(_BASE) + ord(c) + 1) % (1 << 64)
        return mix(np.array([(total + len(piece)) % (1 << 64)], np.uint64))[0]

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the neighbours of best rank, leftmost first, until none is left."""
        parts = list(text)
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank > best):
                    best, at = rank, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _merges(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """Of the merges that make a piece alone: their ranks, and the first and last part before and after each; None if they
        make no single piece."""
        if piece not in self.alone:
            parts, ranks = list(self.text[piece]), []
            firsts, lasts = [parts[0]], [parts[-1]]
            while True:
                found = [self.rank.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
                best = max((r for r in found if r is not None), default=None)
                if best is None:
                    break
                at = found.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                ranks.append(best)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self.alone[piece] = (ranks, firsts, lasts) if len(parts) == 1 else None
        return self.alone[piece]

    def _follows(self, before: int, piece: int) -> bool:
        """Whether merging the text of both gives just these two; of a piece at the start or after a character that merges with
        nothing, whether merging gives it."""
        right = self._merges(piece)
        left = self._merges(before) if before >= 0 else None
        if right is None or before < 0:
            return right is not None
        if left is None:
            return False
        (left_ranks, _, lasts), (right_ranks, firsts, _) = left, right
        i = j = 0
        while True:
            across = self.rank.get(lasts[i] + firsts[j])
            a = left_ranks[i] if i < len(left_ranks) else None
            b = right_ranks[j] if j < len(right_ranks) else None
            # of equal ranks the leftmost is merged first
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or (a is not None and a >= b):
                i += 1
            else:
                j += 1

    def _allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        width = np.int64(len(self.raw) + 2)
        pairs = (before + 2) * width + piece
        place = (mix(pairs) & np.uint64(PAIR_PLACES - 1)).astype(np.int64)
        held = self.pair_places[place]  # twice the pair, and one more if it is allowed
        fits = held & 1 == 1
        other = np.flatnonzero(held >> 1 != pairs)
        if len(other):
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs = {}
            different, back = np.unique(pairs[other], return_inverse=True)
            known = np.empty(len(different), bool)
            for k, pair in enumerate(different.tolist()):
                follows = self.pairs.get(pair)
                if follows is None:
                    follows = self.pairs[pair] = self._follows(pair // int(width) - 2, pair % int(width))
                known[k] = follows
            fits[other] = known[back]
            self.pair_places[place[other]] = pairs[other] * 2 + fits[other]
        return fits

    def segment(self, words: list[str]) -> list[np.ndarray]:
        """Piece ids of words of any length; -2 for a character without piece."""
        flat, ends = self._searched(words)
        return np.split(flat, ends[:-1])

    def _searched(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of all words in a row, and where those of each word end.

        Shorter words are padded with the character 0, which is in no piece. What stands behind a place changes nothing before it.
        """
        n, sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        size = int(sizes.max())
        chars = np.array(words, f"<U{size}").view(np.uint32).reshape(n, size)
        sums = np.zeros((size + 1, n), np.uint64)
        for j in range(size):
            sums[j + 1] = sums[j] * _BASE + chars[:, j] + np.uint64(1)
        powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        last = np.full((size + 1, n), _UNKNOWN, np.int64)
        length = np.ones((size + 1, n), np.int64)
        best = np.zeros((size + 1, n))
        last[0] = _START
        for j in range(1, size + 1):
            best[j] = best[j - 1] + self.unknown_score
            open_ = np.ones(n, bool)
            for k in range(min(j, self.longest), 0, -1):
                keys = mix(sums[j] - sums[j - k] * powers[k] + np.uint64(k))
                at = np.flatnonzero(self.flags[keys & np.uint64(KEY_FLAGS - 1)] & open_)
                slot = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
                same = self.keys[slot] == keys[at]
                at, slot = at[same], slot[same]
                if not len(at):
                    continue
                piece = self.ids[slot]
                if self.kind == "bpe":
                    fits = self._allowed(last[j - k][at], piece)
                    at, piece = at[fits], piece[fits]
                    open_[at] = False
                else:
                    total = best[j - k][at] + self.scores[slot]
                    better = (total > best[j][at]) | (last[j][at] == _UNKNOWN) & (total >= best[j][at])
                    at, piece = at[better], piece[better]
                    best[j][at] = total[better]
                last[j][at], length[j][at] = piece, k
        return self._followed(last, length, sizes)

    @staticmethod
    def _followed(last: np.ndarray, length: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, rows, steps = sizes.copy(), np.arange(len(sizes)), []
        while (at > 0).any():
            steps.append(np.where(at > 0, last[at, rows], _START))
            at = np.where(at > 0, at - length[at, rows], 0)
        table = np.stack(steps[::-1], axis=1)
        kept = table != _START
        return table[kept], np.cumsum(np.count_nonzero(kept, axis=1))

    def _spelled(self, word: str, found: np.ndarray) -> np.ndarray:
        """With the bytes of the characters that have no piece."""
        if (found >= 0).all():
            return found.astype(np.int32)
        out, at = [], 0
        for piece in found.tolist():
            if piece >= 0:
                out.append(piece)
                at += len(self.text[piece])
            else:
                out += [self.byte_id[b] for b in word[at].encode("utf-8", "surrogatepass")]
                at += 1
        return np.array(out, np.int32)

    def _parts(self, word: str) -> list[str]:
        """A long word cut between characters that no piece holds next to each other; what is joined across there is no piece."""
        if len(word) <= LONG_WORD:
            return [word]
        joined = self.joined
        cuts = [0, *[i for i, pair in enumerate(map("".join, zip(word, word[1:], strict=False)), 1) if pair not in joined], len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _segmented(self, words: list[str]) -> list[bytes]:
        """Ids of words as 32-bit numbers."""
        flat, ends = self._searched(words)
        ids, ends = flat.astype(np.int32).tobytes(), ends.tolist()
        found = [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(flat == _UNKNOWN), "right")).tolist():
            found[i] = self._spelled(words[i], flat[ends[i - 1] if i else 0 : ends[i]]).tobytes()
        return found

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, as 32-bit numbers; those of similar length are segmented together."""
        parts = {w: self._parts(w) for w in words if len(w) > LONG_WORD}
        apart = {p for cut in parts.values() for p in cut if p not in self.words}
        ordered = sorted(apart.union(w for w in words if len(w) <= LONG_WORD), key=len)
        new, begin = {}, 0
        while begin < len(ordered):
            longest = max(len(ordered[begin]) + 3, len(ordered[begin]) * 5 // 4)
            end = bisect.bisect_right(ordered, longest, lo=begin, hi=min(len(ordered), begin + max(1, BATCH_CHARS // longest)), key=len)
            part = ordered[begin:end]
            new.update(zip(part, self._segmented(part), strict=True))
            begin = end
        ids = lambda p: new.get(p) or self.words[p]
        return new | {w: b"".join(map(ids, cut)) for w, cut in parts.items() if len(cut) > 1}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids of each text; none for a null or empty one."""
        cut = [self.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        words = list(itertools.chain.from_iterable(cut))
        ids = list(map(self.words.get, words))  # one look for each word
        new = self._new(list(dict.fromkeys(w for w, i in zip(words, ids, strict=True) if i is None)))
        ids = [new[w] if i is None else i for w, i in zip(words, ids, strict=True)]
        if len(self.words) < REMEMBERED:
            self.words.update((w, i) for w, i in new.items() if len(w) <= REMEMBERED_CHARS)
        ends = list(itertools.accumulate(map(len, cut)))
        return [np.frombuffer(b"".join(ids[a:b]), np.int32) for a, b in zip([0, *ends], ends, strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of piece ids; bytes that form no character become U+FFFD."""
        joined = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(SPACE, " ")
        return joined[1:] if joined.startswith(" ") else joined


_loaded: dict[tuple[str, str], Pieces] = {}


def load(path: str, kind: str = "bpe") -> Pieces:
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Pieces(path, kind)
    return _loaded[path, kind]


def encode(docs: DataFrame, model_path: str, kind: str = "bpe") -> DataFrame:
    """doc_id and ids (array of int) of every row and its whole text.

    A null text has null ids, an empty one none. Null ids stay, repeated rows stay repeated, an empty table gives an empty one.
    Only doc_id and text are read, other columns may have any name. The model file is read by every worker, so its path must
    lead to it on all machines.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_path, kind)
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for part in batches(texts, BATCH_CHARS):
                found = [None if t is None else ids for t, ids in zip(texts[part], pieces.encode(texts[part]), strict=True)]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[part].array, "ids": found})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str, kind: str = "bpe") -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give a null text, no ids an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_path, kind)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "text": [None if i is None else pieces.decode(np.asarray(i)) for i in frame["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def encoded_digests(docs: DataFrame, model_path: str, kind: str = "bpe") -> DataFrame:
    """doc_id, n_ids, ids_crc32 (unsigned little-endian 32-bit ids) and round_trip: whether decoding gives the text.

    The rows of ``encode`` and ``decode`` in one pass, for a table whose ids nobody stores; null texts have 0 ids.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = load(model_path, kind)
        for frame in frames:
            texts = [t if isinstance(t, str) else None for t in frame["text"]]
            for part in batches(texts, BATCH_CHARS):
                found = pieces.encode(texts[part])
                same = [pieces.decode(ids) == (t or "").replace(SPACE, " ") for t, ids in zip(texts[part], found, strict=True)]
                digests = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in found]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[part].array, "n_ids": list(map(len, found)), "ids_crc32": digests, "round_trip": same})

    schema = "doc_id long, n_ids long, ids_crc32 long, round_trip boolean"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, schema)
