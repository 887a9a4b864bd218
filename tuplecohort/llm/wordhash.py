"""64-bit hashes of words, bytes and shingles of many texts at once, with array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix64

PIECE = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
#: A fixed odd 64-bit value for each byte.
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo 2^64."""
    if name not in _powers or len(_powers[name]) <= n:
        p = np.full(max(n, PIECE) + 1, base, np.uint64)
        p[0] = 1
        _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers[name]


class SpanHash:
    """Hashes of any spans of one byte array: equal bytes have equal hashes, wherever they stand."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data] * _power("up", _BASE, n)[:n], out=self.sums[1:])
        self.down = _power("down", pow(_BASE, -1, 1 << 64), n)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.down[start])


#: Primes under 2^31, so that a product of two remainders fits in 64 bits, and a base for each (fixed).
_PRIMES = ((2147483647, 1291676017), (2147483629, 873242111))


def _prime_powers(p: int, base: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo p, for n below PIECE or so; kept."""
    name = f"{p}-{base}"
    if name not in _powers or len(_powers[name]) <= n:
        out = np.ones(1, np.uint64)
        while len(out) <= max(n, PIECE):
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
        _powers[name] = out
    return _powers[name]


class PrimeSpanHash:
    """As :class:`SpanHash`, modulo two primes: no text is known beforehand whose equal sums are not equal bytes
    (modulo 2^64, words like abba baab ... collide at any base)."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = []
        for p, base in _PRIMES:
            sums = np.zeros(len(data) + 1, np.uint64)
            # The sum stays below 2^64: each term is under 2^31.
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _prime_powers(p, base, len(data))[:len(data)] % np.uint64(p),
                      out=sums[1:])
            self.sums.append(sums)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        parts = []
        for (p, base), sums in zip(_PRIMES, self.sums):
            down = _prime_powers(p, pow(base, -1, p), len(sums))
            parts.append((sums[stop] - sums[start]) % np.uint64(p) * down[start] % np.uint64(p))
        return mix64(parts[0] | parts[1] << np.uint64(32))


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Parts of about PIECE bytes, cut after a separator."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        while end < len(raw) and not _SPACE[raw[end - 1]]:
            end += 1
        yield raw[at:end]
        at = end


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """Per text the hashes of its white-space separated words, A-Z as a-z, in order."""
    parts = [(d, piece) for d, t in enumerate(texts) for piece in _pieces((t or "").encode("utf-8", "surrogatepass"))]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    at = 0
    while at < len(parts):
        end, size = at, 0
        while end < len(parts) and (end == at or size + len(parts[end][1]) < PIECE):
            size += len(parts[end][1]) + 1
            end += 1
        run = parts[at:end]
        data = _LOW[np.frombuffer(b" ".join([p for _, p in run]) + b" ", np.uint8)]
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], space])))
        start, stop = edge[0::2], edge[1::2]
        h = PrimeSpanHash(data)(start, stop)
        cut = np.searchsorted(start, np.cumsum([len(p) + 1 for _, p in run]))
        for (d, _), a, b in zip(run, np.concatenate([[0], cut[:-1]]), cut):
            out[d].append(h[a:b])
        at = end
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


_MULTIPLIERS = mix64(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes (unsigned); with fewer words the whole sequence is one shingle."""
    if len(words) == 0:
        return words
    k = min(size, len(words))
    n = len(words) - k + 1
    h = words[:n] * _MULTIPLIERS[0]
    for i in range(1, k):
        h = mix64(h) + words[i:n + i] * _MULTIPLIERS[i]
    return np.unique(mix64(h + np.uint64(k)))
