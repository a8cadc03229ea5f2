"""Sets of word shingles as sorted arrays of 64-bit hashes, for many texts at a time."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from terrace.llm.common import U, WordHashes, Words, window_hashes


def shingle_sets(texts: list[bytes | None], size: int, cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): text i's distinct shingles, sorted, are hashes[starts[i]:starts[i + 1]].

    A-Z is lower-cased. A text with fewer than ``size`` words has its whole word sequence as one shingle; one without
    words has none.
    """
    w = Words(texts, cache, fold=True)
    n, counts = len(texts), np.diff(w.starts)
    h = window_hashes(w.hashes, size)
    owner = w.owner()
    whole = owner[: len(h)] == owner[size - 1 :] if len(h) else np.zeros(0, bool)
    h, own = h[whole], owner[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.array([window_hashes(w.hashes[w.starts[i] : w.starts[i + 1]], int(counts[i]))[0] for i in short], U)
        h, own = np.concatenate([h, extra]), np.concatenate([own, short])
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    if len(h):
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        h, own = h[first], own[first]
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(own, minlength=n), out=starts[1:])
    return h, starts


def signatures(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a digest of each sorted set hashes[starts[i]:starts[i + 1]], as two signed numbers; with its size they stand for the set."""
    data, ends = hashes.tobytes(), (8 * starts).tolist()
    both = b"".join(blake2b(data[a:b], digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True))
    pairs = np.frombuffer(both, "<i8").reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()
