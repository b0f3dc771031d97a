"""Word and shingle hashes of whole texts, computed over arrays of bytes."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RNG = np.random.default_rng(20240229)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[_SPACE] = 0
_POWER_BITS = 12
_POWER = np.cumprod(np.full(1 << _POWER_BITS, 0x9E3779B97F4A7C15, np.uint64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FAR = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of bytes that are not ASCII white space."""
    space = _SPACE[buf]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    gaps = np.diff(starts, append=len(buf))
    at = np.arange(starts[0], len(buf)) - np.repeat(starts, gaps)
    weight = _POWER[at & ((1 << _POWER_BITS) - 1)]
    if gaps.max() > 1 << _POWER_BITS:
        weight = weight + (at >> _POWER_BITS).astype(np.uint64) * _FAR
    return starts, mix(np.add.reduceat(_BYTE[buf[starts[0]:]] * weight, starts - starts[0]))


def _cuts(raw: bytes, most: int) -> Iterator[bytes]:
    """Parts of about ``most`` bytes, cut at white space only."""
    at = 0
    while len(raw) - at > most:
        end = at + most
        while end < len(raw) and raw[end] not in b" \t\n\v\f\r":
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(texts: list[bytes], most: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each.

    Words are runs of bytes other than ASCII white space.  Work goes on in
    parts of about ``most`` bytes, so long texts need no larger buffers than
    their own hashes."""
    counts = np.zeros(len(texts), np.int64)
    out, group, owners, held = [], [], [], 0

    def run() -> None:
        joined = np.frombuffer(b" ".join(group), np.uint8)
        starts, hashes = _word_hashes(joined)
        ends = np.cumsum([len(g) + 1 for g in group])
        np.add.at(counts, np.array(owners)[np.searchsorted(ends, starts, side="right")], 1)
        out.append(hashes)

    for k, raw in enumerate(texts):
        for part in _cuts(raw, most):
            group.append(part)
            owners.append(k)
            held += len(part)
            if held >= most:
                run()
                group, owners, held = [], [], 0
    if group:
        run()
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; of the whole run where there are fewer."""
    n = len(words)
    if not n:
        return words
    size = min(k, n)
    h = words[:n - size + 1].copy()
    for i in range(1, size):
        h = mix(h) + words[i:n - size + 1 + i]
    return mix(h + np.uint64(size))
