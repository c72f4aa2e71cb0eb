"""Words, word hashes and batches of texts as numpy arrays: the ground the text operators share.

A word is a run of code points outside ``\\x20 \\x09-\\x0D``. Texts are handled as UTF-8 bytes; the separators are ASCII,
so a word never begins inside a character. Texts of a batch are laid one after the other and worked on together; a
batch is closed when its texts reach ``BATCH_BYTES``, so memory follows the longest text, not the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of text that are worked on at once; a single longer text makes a batch of its own.
BATCH_BYTES = 1 << 18

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit of the input reaches every bit of the output."""
    x = np.asarray(x, np.uint64).copy()
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, size: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < size:
        held = np.full(max(size, 2 * BATCH_BYTES), base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        if size <= 4 * BATCH_BYTES:  # those of an unusually long text are not kept
            _powers[name] = held
    return held[:size]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


@dataclass
class Batch:
    """Texts laid end to end, each followed by one newline that belongs to no word."""

    data: np.ndarray  # bytes
    start: np.ndarray  # first byte of each text
    end: np.ndarray  # byte after each text

    @classmethod
    def of(cls, texts: list[str | None], lower: bool = False) -> Batch:
        parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"\n".join([*parts, b""])
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]]).astype(np.int64) if parts else size
        return cls(np.frombuffer(joined.translate(_LOWER) if lower else joined, np.uint8), start, start + size)

    def __len__(self) -> int:
        return len(self.start)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, byte after the last, and text number of every word, in order."""
        inside = ~IS_SPACE[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        first, after = edge[::2], edge[1::2]
        return first, after, np.searchsorted(self.start, first, "right") - 1

    def prefix(self) -> np.ndarray:
        """Running sums from which the hash of any byte range follows; see ``hashes``."""
        n = len(self.data)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.data] * _power("up", _BASE, n), dtype=np.uint64)])

    def hashes(self, first: np.ndarray, after: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each byte range; equal bytes give equal hashes wherever they stand."""
        total = self.prefix() if prefix is None else prefix
        down = _power("down", _BASE_INVERSE, len(self.data) + 1)
        return mix((total[after] - total[first]) * down[first] + mix((after - first).astype(np.uint64)))

    def count(self, flags: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """How many flagged bytes each byte range holds."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[after] - total[first]


def batches(texts: list[str | None], limit: int = BATCH_BYTES) -> Iterator[slice]:
    """Cut a list of texts into runs of about ``limit`` characters; a longer text is a run of its own."""
    begin = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > begin and held + size > limit:
            yield slice(begin, i)
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield slice(begin, len(texts))


def starts_of(owner: np.ndarray, n: int) -> np.ndarray:
    """For ascending group numbers: where each of the ``n`` groups begins, and the end."""
    return np.searchsorted(owner, np.arange(n + 1))
