"""Hashes of word shingles, and the fingerprint that most of them agree on."""

from __future__ import annotations

from functools import partial

import numpy as np


def hashes_of(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of all shingles of a text, repeats included; a shorter text is one shingle."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    parts = [words[i:] for i in range(min(shingle, len(words)))]
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    return np.fromiter(map(digest, map(b" ".join, zip(*parts))), dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        octets = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])
