"""Brute-force versions that several tests share."""

import numpy as np

from terrasheaf.llm import near_copies
from terrasheaf.llm.common import merge_labels


def near_components(texts):
    """Root of each text under the stated rule of near copies, from all pairs of texts."""
    sets = [set(near_copies.shingle_set(t).tolist()) for t in texts]
    fps = near_copies.fingerprints_of([near_copies.shingle_set(t) for t in texts]).view(np.uint64)
    apart = np.bitwise_count(fps[:, None] ^ fps[None]).astype(int)
    sums = sum(np.roll(apart, -k, axis=2) for k in range(near_copies.TESTED))
    blocks = fps.view(np.uint16).reshape(*fps.shape, near_copies.BLOCKS)
    meet = (blocks[:, None] == blocks[None]).any(axis=3)
    i, j = np.nonzero((meet & (apart <= near_copies.MOST) & (sums <= near_copies.TOTAL)).any(axis=2))
    like = [a == b or len(sets[a] & sets[b]) >= near_copies.LEAST * len(sets[a] | sets[b]) for a, b in zip(i, j)]
    lab = np.arange(len(texts))
    merge_labels(lab, i[like], j[like])
    return lab
