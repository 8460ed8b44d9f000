"""64-bit hashes of a text's words, kept per worker."""

from __future__ import annotations

import numpy as np
import xxhash

from .worker import kept

#: Words kept per worker; when full, the store starts anew. Bounds memory and changes no result.
KEEP = 1 << 17


def word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of a text in UTF-8, A-Z lowered."""
    words = raw.lower().split()
    known: dict[bytes, int] = kept("word-hashes", dict, large=True)
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        new = set(words).difference(known)
        if len(known) + len(new) > KEEP:
            known.clear()
            new = set(words)
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
