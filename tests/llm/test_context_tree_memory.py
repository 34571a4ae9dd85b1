"""Merging sorted keys: sums as by plain counting, in memory bounded beside input and result."""

import tracemalloc

import numpy as np
import pytest

from panelkit.llm import context_tree


def _arrays(n_arrays, n_keys, top, seed=0):
    draw = np.random.default_rng(seed)
    keys = [np.unique(draw.integers(0, top, n_keys).astype(np.uint64)) for _ in range(n_arrays)]
    return keys, [draw.integers(0, 9, len(k)) for k in keys]


@pytest.mark.parametrize("n_arrays, n_keys, top", [
    (12, 60_000, 1 << 62), (12, 60_000, 70_000), (1, 700_000, 1 << 40), (300, 900, 3000), (3, 1, 2), (1, 0, 9), (0, 0, 9),
])
def test_merged_sums_equal_plain_counting(n_arrays, n_keys, top):
    keys, counts = _arrays(n_arrays, n_keys, top)
    if n_arrays > 2:
        keys.append(np.zeros(0, np.uint64))
        counts.append(np.zeros(0, np.int64))
    got, n = context_tree._summed(keys, counts)
    every = np.concatenate([np.zeros(0, np.uint64), *keys])
    distinct, at = np.unique(every, return_inverse=True)
    assert (got == distinct).all() and n.dtype == np.int64
    assert (n == np.bincount(at, weights=np.concatenate([[], *counts]), minlength=len(distinct))).all()


def test_sums_of_small_counts_do_not_overflow():
    one = [np.array([7], np.uint64)] * 3
    assert context_tree._summed(one, [np.array([1 << 30], np.int32)] * 3)[1].tolist() == [3 << 30]


def test_merging_needs_little_beside_input_and_result():
    keys, counts = _arrays(16, 200_000, 1 << 60)
    total = sum(map(len, keys))
    tracemalloc.start()
    try:
        context_tree._summed(keys, counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 16 bytes a key for the result; before it was merged by ranges the peak was above 40.
    assert peak < 28 * total
