"""The binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit words.

The code is perfect: every word lies within distance 3 of exactly one codeword, and within
distance 4 of one codeword (when that distance is below 3) or of six.  Two words at distance 2 or less
have a word between them at distance 1 or less from both; its nearest codeword is within 4 of both.  So the indices of the
codewords within distance 4 are keys of which two words at distance 2 or less share one.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

N, K = 23, 12
GENERATOR = 0b101011100011     # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
KEYS = 6


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word modulo the generator polynomial."""
    r = words.astype(np.uint32)
    for bit in range(N - 1, N - K - 1, -1):
        r = np.where((r >> bit) & 1, r ^ np.uint32(GENERATOR << (bit - (N - K))), r)
    return r


@lru_cache(maxsize=1)
def error_patterns() -> np.ndarray:
    """(2048, 6) error patterns of weight 4 or less by syndrome; unused places repeat the first."""
    found: list[list[int]] = [[] for _ in range(1 << (N - K))]
    for weight in range(5):
        patterns = np.array([sum(1 << b for b in c) for c in combinations(range(N), weight)], np.uint32)
        for p, s in zip(patterns.tolist(), syndrome(patterns).tolist()):
            found[s].append(p)
    assert max(map(len, found)) == KEYS
    return np.array([f + [f[0]] * (KEYS - len(f)) for f in found], np.uint32)


def near_codewords(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices (12 bits) of the codewords within distance 4; the first is the nearest,
    and places beyond those there are repeat it."""
    e = error_patterns()[syndrome(words)]
    return (words.astype(np.uint32)[:, None] ^ e) >> np.uint32(N - K)
