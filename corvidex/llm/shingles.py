"""Word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def seed(*path: int) -> int:
    """A 64-bit number for a path of small numbers."""
    return xxhash.xxh3_64_intdigest(np.array(path, np.uint64).tobytes())


#: A random number for each byte; A-Z count as a-z, and the six ASCII spaces separate words.
_BYTE = np.array([seed(78, b + 32 if 65 <= b <= 90 else b) for b in range(256)], np.uint64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_ODD = 0x9E3779B97F4A7C15
#: Bytes hashed at once: arrays of so many numbers stay in the cache.
_BYTES = 1 << 18


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0`` to ``base ** n`` modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = powers(_ODD, _BYTES), powers(pow(_ODD, -1, 1 << 64), _BYTES)


def _hashes_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of at most ``_BYTES`` bytes and its start: bytes weighted by powers of an odd number, which the start divides out."""
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * _UP[: len(raw)], dtype=np.uint64)))
    return mix((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64)), start


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and each text's number of words."""
    body = b" ".join(texts) + b" "
    raw = np.frombuffer(body, np.uint8)
    parts, starts = [], []
    at = 0
    while at < len(raw):
        # Cut where a word ends; a word that is longer than a part is hashed by itself.
        end = min(at + _BYTES, len(raw))
        if end < len(raw):
            blank = np.flatnonzero(_SPACE[raw[at:end]])
            if len(blank):
                end = at + int(blank[-1]) + 1
            else:
                blank = np.flatnonzero(_SPACE[raw[end:]])
                end += int(blank[0])
        if end - at > _BYTES:
            text = body[at:end].lower()
            parts.append(np.array([xxhash.xxh3_64_intdigest(text)], np.uint64))
            starts.append(np.array([at]))
        else:
            h, start = _hashes_of(raw[at:end])
            parts.append(h)
            starts.append(start + at)
        at = end
    hashes, starts = np.concatenate(parts), np.concatenate(starts)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)


def shingles_of(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, one after the other, and each text's number of them; fewer words than ``width``, but not none, make one."""
    words, n = word_hashes(texts)
    if not len(words):
        return words, n
    end = np.cumsum(n)
    short = np.flatnonzero((n > 0) & (n < width))
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    out = np.empty(int(count.sum()), np.uint64)
    last = np.cumsum(count)
    if len(words) >= width:
        every = shingle_hashes(words, width)
        # A shingle stays in its text: the last places of each are none.
        whole = np.ones(len(words), bool)
        for k in range(1, width):
            whole[end[n >= k] - k] = False
        place = np.ones(len(out), bool)
        place[last[short] - 1] = False
        out[place] = every[whole[: len(every)]]
    for k in short.tolist():
        out[last[k] - 1] = shingle_hashes(words[end[k] - n[k] : end[k]], width)[0]
    return out, count


def shingle_hashes(word_hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash for each run of ``width`` words; fewer words, but not none, make one shingle."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    if n < width:
        word_hashes, width = word_hashes, n
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out += word_hashes[k : n - width + 1 + k] * np.uint64(seed(77, k) | 1)
    return mix(out)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII spaces, A-Z in lower case."""
    return text.lower().split()


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    return np.unique(shingles_of([text], width)[0])


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """The different shingles of each text, sorted."""
    s, n = shingles_of(texts, width)
    return [np.unique(x) for x in np.split(s, np.cumsum(n)[:-1])] if len(texts) else []
