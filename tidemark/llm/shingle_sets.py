"""Word shingle sets as sorted 64-bit hashes, and their bitmaps."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_EMPTY = np.zeros(0, dtype=np.uint64)


#: A random number for each byte, A-Z as a-z; a word's hash is a polynomial over them, modulo 2^64.
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
#: Texts are hashed in stretches of so many bytes, or of one word.
STRETCH = 1 << 16
_POWERS = _INVERSE = np.ones(0, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, STRETCH)
        _POWERS, _INVERSE = (np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, x, dtype=np.uint64))) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _POWERS, _INVERSE


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: np.ndarray) -> np.ndarray:
    """Hashes of the words of a stretch, in order."""
    blank = _BLANK[text]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edges = np.concatenate([[0], edges])
    if not blank[-1]:
        edges = np.concatenate([edges, [len(text)]])
    powers, inverse = _powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[text] * powers[: len(text)], out=sums[1:])
    starts = edges[::2]
    return (sums[edges[1::2]] - sums[starts]) * inverse[starts]


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of all words of a text; a word has the same wherever it stands."""
    data = np.frombuffer(text, dtype=np.uint8)
    if len(data) <= STRETCH:
        return _word_hashes(data) if len(data) else _EMPTY
    parts, at = [], 0
    while at < len(data):
        end = min(at + STRETCH, len(data))
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        parts.append(_word_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a UTF-8 text, ascending. Words are runs without ASCII white space, after A-Z became a-z.

    A text of fewer words is one shingle of all of them; without words the set is empty.
    """
    h = word_hashes(text) if text else _EMPTY
    n = len(h)
    if not n:
        return _EMPTY
    k = min(n, width)
    out = np.full(n - k + 1, k, dtype=np.uint64)
    h = _mixed(h)
    for j in range(k):
        out *= _A
        out += h[j : n - k + 1 + j]
    out = _mixed(out)
    out.sort()
    new = out[1:] != out[:-1]
    return out if new.all() else out[np.concatenate([[True], new])]


def bitmap_words(n: int) -> int:
    """64-bit words of the bitmap of a set of n tokens: 16 to 32 bits a token, a power of two, at most a megabit.

    So few tokens share a bit that the bound of may_be_similar falls hardly short of the true overlap.
    """
    return 1 << max(0, min(14, (n - 1).bit_length() - 2))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A bit for each token's low bits; wider for larger sets."""
    size = bitmap_words(len(tokens)) * 64
    bits = np.zeros(size, dtype=bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap that fewer words would have given."""
    return bits if len(bits) == words else np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def may_be_similar(a: np.ndarray, n: int, b: np.ndarray, m: int, percent: int) -> bool:
    """False only for sets (of n and m tokens, by their bitmaps) whose overlap can't suffice.

    Shared tokens set shared bits, and tokens that share a bit with others of their set number n - bits at most.
    """
    if n * 100 < m * percent or m * 100 < n * percent:
        return False
    words = min(len(a), len(b))
    a, b = folded(a, words), folded(b, words)
    x, y, both = (int(np.bitwise_count(v).sum()) for v in (a, b, a & b))
    return min(both + min(n - x, m - y), n, m) * (100 + percent) >= (n + m) * percent


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that name the set, as two signed numbers."""
    both = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), dtype=np.int64)
    return int(both[0]), int(both[1])


def prefix_length(n: int, percent: int) -> int:
    """So many tokens of a set, the first in any common order, meet the prefix of every set with that similarity."""
    return n - -(-n * percent // 100) + 1


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, exactly."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) * 100 < len(b) * percent:
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both * 100 >= (len(a) + len(b) - both) * percent
