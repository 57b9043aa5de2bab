"""Repeated passages: a slice of many documents is looked at as one array, with the results of each document by itself."""

import random

import numpy as np
import pytest

from rentmart.llm.repeats import CONTEXT, anchors, first_least, spans, spread_for, symbols


def slice_of(seed=1):
    r = random.Random(seed)
    sizes = [0, 3, 34, 35, 36, 0, 200, 12, 1000, 35]
    h = np.array([r.choice([5, 7, 9, r.randrange(1 << 60)]) for _ in range(sum(sizes))], np.uint64)
    return h, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def alone(n):
    return np.array([0, n], np.int64)


def test_symbols_end_with_their_document():
    h, first = slice_of()
    starts, names = symbols(h, first)
    got = [(int(s), int(x)) for s, x in zip(starts, names, strict=True)]
    want = [(int(s + a), int(x)) for a, b in zip(first[:-1], first[1:], strict=True) if a < b for s, x in zip(*symbols(h[a:b], alone(b - a)), strict=True)]
    assert got == want


@pytest.mark.parametrize("window", [12, 20, 35])
def test_anchors_of_a_slice(window):
    h, first = slice_of()
    want = set()
    wide = spread_for(window)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a < window:
            continue
        starts, names = symbols(h[a:b], alone(b - a))
        rank = [1 << 64] * (b - a)
        for s, x in zip(starts.tolist(), names.tolist(), strict=True):
            rank[s] = x
        for at in range(b - a - window + 2 * CONTEXT + 1):
            want.add(a + min(range(at, at + wide), key=lambda i: (rank[i], i)))
    assert anchors(h, first, window).tolist() == sorted(want)


def test_first_least_and_spans():
    values = np.array([3, 1, 1, 2, 0, 0, 5, 1], np.uint64)
    assert first_least(values, 3).tolist() == [1, 1, 4, 4, 4, 5]
    assert first_least(values, 1).tolist() == list(range(8))
    assert spans(6, np.array([1, 1, 9]), np.array([3, 2, 9])).tolist() == [False, True, True, False, False, False]
