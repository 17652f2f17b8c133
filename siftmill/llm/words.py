"""Words of texts as arrays: where they lie, and 64-bit hashes of words and of runs of words, without a step per word."""

from __future__ import annotations

import numpy as np

_R = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_P, _Q, _M = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xBF58476D1CE4E5B9))
#: Words whose hashes are computed together, so that the arrays stay in a core's cache.
STEP = 16_384


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M
    return x ^ (x >> np.uint64(32))


def joined_words(text: str | None) -> bytes:
    """The words joined by one space; bytes.split() cuts at \\x20 and \\x09-\\x0D."""
    return b" ".join((text or "").encode().split())


def places(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of ``joined`` text, and the byte after its last."""
    if not joined:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(joined)]])


def word_hashes(joined: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A word's bytes weighted by fixed random odd numbers, summed and mixed. Two different words of at most 256 bytes
    have one hash in fewer than one of 2**57 cases; the weights of longer ones repeat, with their place added."""
    out = np.empty(len(starts), np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    for i in range(0, len(starts), STEP):
        s, e = starts[i : i + STEP], ends[i : i + STEP]
        b = raw[s[0] : e[-1]].astype(np.uint64) + np.uint64(1)
        inside = np.arange(len(b)) - np.repeat(s - s[0], np.diff(np.append(s - s[0], len(b))))
        weights = _R[inside & 255]
        if (e - s).max() > 256:
            weights = weights + (inside >> 8).astype(np.uint64) * _P
        b *= weights
        total = np.add.reduceat(b, s - s[0])
        last = np.append(s[1:], e[-1] + 1) - 1 - s[0]  # the space after each word is taken off again
        inner = last[:-1]
        total[: len(inner)] -= b[inner]
        out[i : i + STEP] = mixed(total + (e - s).astype(np.uint64) * _Q)
    return out


def runs_of(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``width`` consecutive words at every place, by doubling."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    out, size, power, reach = None, 0, h, 1
    rest = width
    while rest:
        if rest & 1:
            if out is None:
                out, size = power, reach
            else:
                n = len(h) - size - reach + 1
                out, size = mixed(out[:n] * _P + power[size : size + n] * _Q + np.uint64(size + reach)), size + reach
        rest >>= 1
        if rest:
            power = mixed(power[:-reach] * _P + power[reach:] * _Q + np.uint64(2 * reach))
            reach *= 2
    return out
