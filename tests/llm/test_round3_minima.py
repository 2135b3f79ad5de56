"""Minima of ranges in induced sorting: few ranges one by one, and first pushes by running minima."""

import sys

import numpy as np

from rtdw.llm import induced


def test_range_minima_equal_plain_ones():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 50, 1000)
    for n in (0, 1, induced.FEW, induced.FEW + 1, 300):
        first = rng.integers(0, 1000, n)
        last = np.minimum(999, first + rng.integers(0, 1000, n))
        assert induced.range_min(values, first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]


def test_first_pushes_need_no_tables(monkeypatch):
    """Ranges from a block's begin made tables of the whole block, over every power of two, for a few pairs."""
    asked, plain = [], induced.range_min

    def watched(values, first, last):
        if sys._getframe(1).f_code.co_name == "_push":
            asked.extend(first.tolist())
        return plain(values, first, last)

    monkeypatch.setattr(induced, "range_min", watched)
    text = np.random.default_rng(4).integers(1, 5, 3000).astype(np.uint16)
    order, common = induced.suffix_array(lambda to: np.copyto(to, text), len(text), 6, 400)
    assert asked and min(asked) > 0
    data = text.tolist()
    expected = sorted(range(len(data) + 1), key=lambda i: data[i:])
    assert np.asarray(order).tolist() == expected
    for a, b, c in zip(expected, expected[1:], np.asarray(common)[1:].tolist(), strict=False):
        same = next((i for i, (x, y) in enumerate(zip(data[a:], data[b:], strict=False)) if x != y), min(len(data) - a, len(data) - b))
        assert c == min(400, same)
