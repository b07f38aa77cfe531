"""Words of a text as spans of bytes, and 64-bit hashes of words and runs of words.

Plain numpy on one text at a time. Two runs of words that are equal have equal hashes
on every machine; the hashes do not depend on the process.
"""

from __future__ import annotations

import numpy as np

SPACES = b"\t\n\x0b\x0c\r"
# Byte tables for bytes.translate: every separator becomes a space.
BY_SPACE = bytes.maketrans(SPACES, b" " * len(SPACES))
BY_SPACE_LOWER = bytes(b + 32 if 65 <= b <= 90 else BY_SPACE[b] for b in range(256))
# Words of digits, letters a-z and everything beyond ASCII.
BY_ALNUM_LOWER = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_CHUNK = 1 << 20


def encode(text: str | None, table: bytes) -> bytes:
    """The text's bytes with separators made spaces; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").translate(table)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of each word of ``data``."""
    edge = np.zeros(len(data) + 2, np.int8)
    edge[1:-1] = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(edge[1:] != edge[:-1])
    return edges[0::2], edges[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of words and of runs of words; another ``seed`` gives independent ones."""

    def __init__(self, seed: int = 1):
        numbers = mix(np.arange(260, dtype=np.uint64) + np.uint64(seed * 1000003 + 7))
        self.letters, self.base = numbers[:256], int(numbers[256]) | 1
        self.factor, self.salt = numbers[257] | np.uint64(1), numbers[258]
        self.powers = _powers(self.base, 64)

    def words(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each word, in pieces of about a megabyte."""
        out = np.empty(len(starts), np.uint64)
        raw, done = np.frombuffer(data, np.uint8), 0
        while done < len(starts):
            until = max(done + 1, int(np.searchsorted(ends, starts[done] + _CHUNK)))
            lengths = ends[done:until] - starts[done:until]
            first = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
            if len(self.powers) < lengths.max():
                self.powers = _powers(self.base, int(lengths.max()) * 2)
            at = place + np.repeat(starts[done:until], lengths)
            values = self.letters[raw[at]] * self.powers[place]
            out[done:until] = np.add.reduceat(values, first) + lengths.astype(np.uint64)
            done = until
        return mix(out ^ self.salt)

    def runs(self, words: np.ndarray, length: int) -> np.ndarray:
        """A hash of every run of ``length`` words, by the run's first word."""
        n = max(0, len(words) - length + 1)
        out = np.zeros(n, np.uint64)
        for i in range(length):
            out = out * self.factor + words[i:i + n]
        return mix(out)


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the place of its least one, the first if tied."""
    if len(values) < width:
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(values, width)
    return view.argmin(axis=1) + np.arange(len(view))
