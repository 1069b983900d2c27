"""Sequences and tries against plain arrays."""

import tempfile

import numpy as np
import pytest

from tablebind.llm.elias_fano import EliasFano, Trie


@pytest.mark.parametrize(("n", "top"), [(1, 1), (7, 3), (1000, 10), (5000, 1 << 20), (300, 1 << 45), (70_000, 1 << 30)])
def test_sequence(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    sequence = EliasFano.of(values)
    assert (sequence.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top + 2, 500)])
    zero = np.zeros(len(asked), np.int64)
    assert (sequence.begin(asked >> sequence.low_bits) == np.searchsorted(values >> sequence.low_bits, asked >> sequence.low_bits)).all()
    found = sequence.find(asked, zero, zero + n)
    at = np.searchsorted(values, asked)
    there = (at < n) & (values[np.minimum(at, n - 1)] == asked)
    assert (found == np.where(there, at, -1)).all()


def test_trie():
    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 400, (30_000, 2)) ** 2, axis=0)
    codes = rng.integers(1, 256, len(pairs))
    known = {tuple(p): c for p, c in zip(pairs.tolist(), codes.tolist(), strict=True)}
    contexts, children = np.arange(0, 1000) ** 2, rng.integers(0, 500, (1000, 50)) ** 2
    trie = Trie.of(pairs[:, 0], pairs[:, 1], codes)
    with tempfile.TemporaryFile() as file:
        mapped = Trie.mapped(file, trie.write(file))
        found = mapped.look_up(contexts, np.full(1000, 50), children.ravel())
    wanted = [known.get((a, b), 0) for a, row in zip(contexts.tolist(), children.tolist(), strict=True) for b in row]
    assert found.tolist() == wanted


def test_empty_trie():
    none = np.zeros(0, np.int64)
    trie = Trie.of(none, none, none)
    assert trie.look_up(np.array([3]), np.array([2]), np.array([1, 2])).tolist() == [0, 0]
