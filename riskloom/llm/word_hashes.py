"""64-bit hashes of words and word windows, shared by the two duplicate operators."""

from __future__ import annotations

KNOWN_WORDS = 200_000
_KNOWN: dict[bytes, int] = {}


def word_hashes(raw: bytes):
    """uint64 hash of every word ``[^\\x20\\x09-\\x0D]+`` (bytes.split() cuts at exactly these bytes)."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = raw.split()
    known = _KNOWN
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(h):
    """A bijective scramble of uint64 values."""
    import numpy as np

    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(words, width: int):
    """Hash of every run of ``width`` words (fewer words: none)."""
    import numpy as np

    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, width, np.uint64)
    for k in range(width):
        acc = (acc + words[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return mixed(acc)
