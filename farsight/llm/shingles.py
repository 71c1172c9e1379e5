"""Hashed runs of five words, computed with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x5851F42D4C957F2D)
#: ASCII punctuation to spaces.
PLAIN = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_G = np.random.default_rng(11)
_BYTE = _G.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_PIECE = 1 << 16
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of _BASE and of its inverse, ``n`` at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, _PIECE + 1)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.append(np.uint64(1), np.full(n - 1, v, np.uint64)), dtype=np.uint64)
                          for v in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes, starts, ends) of the words of ``raw``, the same on
    every worker: sums of random byte values times powers of an odd base, by
    one running sum over the bytes.  Long texts go in pieces, cut between words."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) > 2 * _PIECE:
        space = np.flatnonzero(_SPACES[data])
        cuts = [0]
        while cuts[-1] < len(data):
            at = np.searchsorted(space, cuts[-1] + _PIECE)
            cuts.append(int(space[at]) + 1 if at < len(space) else len(data))
        parts = [(a, _piece(data[a:b])) for a, b in zip(cuts, cuts[1:])]
        return tuple(np.concatenate([p[i] + (a if i else np.uint64(0)) for a, p in parts]) for i in range(3))
    return _piece(data)


def _piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACES[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * inverse[starts]
        return mixed(h + (ends - starts).astype(np.uint64)), starts, ends


def hashed_texts(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """hashed_words() of each text, computed together."""
    h, starts, ends = hashed_words(b" ".join(raws))
    sizes = np.fromiter(map(len, raws), np.int64, len(raws)) + 1
    at = np.cumsum(sizes) - sizes
    cut = np.searchsorted(starts, np.append(at, sizes.sum())).tolist()
    return [(h[a:b], starts[a:b] - o, ends[a:b] - o) for a, b, o in zip(cut, cut[1:], at.tolist())]


def word_hashes(texts: list[str], plain: bool = False) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in order, case ignored; with
    ``plain`` punctuation separates words too."""
    group, size = [], 0
    for t in texts:
        raw = t.lower().encode("utf-8", "surrogatepass")
        group.append(raw.translate(PLAIN) if plain else raw)
        size += len(raw)
        if size > _PIECE:
            yield from (f[0] for f in hashed_texts(group))
            group, size = [], 0
    if group:
        yield from (f[0] for f in hashed_texts(group))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    return (x ^ (x >> np.uint64(32))) * _STEP


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words, in order.  Fewer words are one run;
    no words, none."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    with np.errstate(over="ignore"):
        out = words[:n - size + 1].copy()
        for k in range(1, size):
            out = out * _STEP + words[k:n - size + 1 + k]
        return mixed(out)
