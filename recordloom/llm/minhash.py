"""MinHash signatures of word shingles."""

from __future__ import annotations

import numpy as np

from recordloom.llm.common import BYTE_VALUES, LOWER, mixed, prefix_sums, span_hashes, word_spans

SHINGLE = 5
COORDINATES = 64
SEEDS = np.random.default_rng(6).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin.

    A text with fewer words than a shingle has its whole sequence as one.
    """
    starts, ends, bounds = word_spans(data, offsets)
    words = prefix_sums(span_hashes(prefix_sums(BYTE_VALUES[LOWER[data]]), starts, ends))
    counts = np.diff(bounds)
    shingles = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    row = np.repeat(np.arange(len(counts)), shingles)
    begin = np.repeat(bounds[:-1], shingles) + np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    end = np.minimum(begin + width, bounds[1:][row])
    keys = span_hashes(words, begin, end)
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
    keys, row = keys[fresh], row[fresh]
    return keys, np.searchsorted(row, np.arange(len(counts) + 1))


def signatures(keys: np.ndarray, bounds: np.ndarray, seeds: np.ndarray = SEEDS) -> np.ndarray:
    """One row of minima (32 bits each) per text; texts without shingles get zeros."""
    out = np.zeros((len(bounds) - 1, len(seeds)), dtype=np.uint32)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        base = mixed(keys)
        for k, seed in enumerate(seeds):
            values = ((base ^ (base >> np.uint64(29))) * seed) >> np.uint64(32)
            out[filled, k] = np.minimum.reduceat(values.astype(np.uint32), bounds[filled])
    return out
