"""Word shingle sets as 64-bit hashes, vectorised over a batch of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_rng = np.random.default_rng(20240229)
#: A random 64-bit value per byte, an odd base and its inverse modulo 2**64.
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_PAD = np.uint64(0x5851F42D4C957F2D)

#: Bytes of text that are hashed at once.
CHUNK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    def __init__(self, base: np.uint64):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            self.table = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, CHUNK_BYTES) - 1, self.base)]), dtype=np.uint64)
        return self.table[:n]


_POW, _INV = _Powers(_BASE), _Powers(_INVERSE)


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, encoded texts) in runs of about ``CHUNK_BYTES``; null: empty; no text is cut."""
    run: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "replace") if isinstance(t, str) else b""
        if run and size + len(b) > CHUNK_BYTES:
            yield first, run
            run, size, first = [], 0, i
        run.append(b)
        size += len(b)
    if run:
        yield first, run


def word_hashes(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order (A-Z lower-cased; words are runs of
    bytes other than the six ASCII white-space bytes), and the words per text."""
    data = np.frombuffer(b" ".join(run) + b" ", np.uint8)
    space = _SPACE[data]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    value = np.cumsum(_BYTE[_FOLD[data]] * _POW.upto(len(data)), dtype=np.uint64)
    h = value[ends - 1] - np.where(starts > 0, value[starts - 1], np.uint64(0))
    h = mix64(h * _INV.upto(len(data))[starts] + (ends - starts).astype(np.uint64))
    text_end = np.cumsum([len(b) + 1 for b in run])
    upto = np.searchsorted(starts, text_end)
    return h, np.diff(upto, prepend=0)


def shingle_hashes(run: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``words``-word shingles in order, and the shingles per text.
    A text of fewer words has one shingle, the whole sequence; one without words none."""
    h, n = word_hashes(run)
    # words - 1 pads after each text let one formula serve short texts, too.
    at = np.arange(len(h)) + np.repeat(np.arange(len(n)) * (words - 1), n)
    padded = np.full(len(h) + len(n) * (words - 1) + words, _PAD)
    padded[at] = h
    rank = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    first = at[(rank <= np.repeat(n, n) - words) | (rank == 0)]
    s = np.zeros(len(first), np.uint64)
    for t in range(words):
        s = s * _STEP[t] + padded[first + t]
    return mix64(s), np.where(n > 0, np.maximum(n - words + 1, 1), 0)


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for _, run in chunks(texts):
        h, n = shingle_hashes(run, words)
        end = np.cumsum(n)
        for a, b in zip(end - n, end):
            yield np.unique(h[a:b])


class MinHasher:
    """``n`` minima of universal hashes ``(a x + b mod 2**64) >> 32`` of the upper 32 shingle bits."""

    def __init__(self, n: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.n = n
        self.a = rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Row i: the minima over text i's shingles (repeats do no harm); texts without shingles: all ones."""
        out = np.full((len(sizes), self.n), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            x = hashes >> np.uint64(32)
            v = np.empty_like(x)
            for i in range(self.n):
                np.multiply(x, self.a[i], out=v)
                np.add(v, self.b[i], out=v)
                out[full, i] = np.minimum.reduceat(v, starts) >> np.uint64(32)
        return out
