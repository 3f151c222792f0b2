"""Sets of hashed word shingles, minhashes of them, and links inside a small group of sets."""

from __future__ import annotations

import numpy as np

#: Text bytes hashed at once.
SEGMENT = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _segment_words(bytes_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of bytes that begin and end with a blank."""
    blank = (bytes_ == 32) | ((bytes_ >= 9) & (bytes_ <= 13))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _STEP))
    inside = np.repeat(starts, lengths)
    at = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (bytes_[inside + at].astype(np.uint64) + np.uint64(1)) * powers[at]
    return starts, mixed(np.add.reduceat(values, np.cumsum(lengths) - lengths))


def _words(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, hashes, low = [], [], 0
    while low < len(joined) - 1:
        high = min(low + SEGMENT, len(joined))
        while high < len(joined) and not (joined[high - 1] == 32 or 9 <= joined[high - 1] <= 13):
            high += 1
        s, h = _segment_words(joined[low:high])
        starts.append(s + low)
        hashes.append(h)
        low = high - 1  # the blank that ends this segment begins the next
        if high == len(joined):
            break
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each text, and where each text's begin.

    A-Z in lower case; words lie between blanks; a text of fewer than ``k`` words is one
    shingle; without words there is none.
    """
    parts = [t.encode().lower() if t else b"" for t in texts]
    begins = np.cumsum([1] + [len(p) + 1 for p in parts])
    joined = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    starts, words = _words(joined)
    owner = np.searchsorted(begins, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    values, owners = [], []
    if len(words) >= k:
        n = len(words) - k + 1
        value = np.zeros(n, np.uint64)
        for j in range(k):
            value = value * _MULTIPLIER + words[j : j + n]
        whole = owner[:n] == owner[k - 1 :]
        values.append(mixed(value[whole]))
        owners.append(owner[:n][whole])
    first = np.concatenate(([0], np.cumsum(counts)))
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        value = np.uint64(counts[i])
        with np.errstate(over="ignore"):
            for word in words[first[i] : first[i + 1]]:
                value = value * _MULTIPLIER + word
        values.append(mixed(np.array([value], np.uint64)))
        owners.append(np.array([i]))
    if not values:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, int)
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def minhashes(value: np.ndarray, offsets: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """(texts, n) 32-bit minhashes; zeros for a text without shingles."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = np.zeros((len(offsets) - 1, n), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        for i in range(n):
            turned = ((value * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32)
            out[full, i] = np.minimum.reduceat(turned, offsets[full])
    return out


def fingerprints(value: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set; sets with both and the size equal are taken for the same."""
    out = np.zeros((2, len(offsets) - 1), np.uint64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[0, full] = np.add.reduceat(mixed(value), offsets[full])
        out[1, full] = np.add.reduceat(mixed(value ^ _MULTIPLIER), offsets[full])
    return out[0].view(np.int64), out[1].view(np.int64)


def linked_pairs(
    value: np.ndarray, offsets: np.ndarray, percent: int, columns: int = 4096
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets whose shared part is ``percent`` of their union or more.

    Shared shingles are counted by products of 0/1 matrices, some columns at a time; shingles
    that only one set holds cannot be shared and are left out.
    """
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, held = np.unique(value, return_inverse=True, return_counts=True)
    common = held[column] > 1
    used, column = np.unique(column[common], return_inverse=True)
    owner = owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    shared = np.zeros((len(sizes), len(sizes)), np.float32)
    for low in range(0, len(used), columns):
        a, b = np.searchsorted(column, [low, low + columns])
        part = np.zeros((len(sizes), min(columns, len(used) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        shared += part @ part.T
    # Counts stay exact in float32 below 2**24, then whole numbers decide.
    shared = shared.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - shared
    close = np.triu((100 * shared >= percent * union) & (shared > 0), 1)
    return np.nonzero(close)
