"""All steps of a shard's texts at once, against one text after the other."""

from __future__ import annotations

import math

import numpy as np
import pytest

from reviewlake.llm import backoff_lm


def test_walk_equals_the_formula():
    rng = np.random.default_rng(4)
    n, total, distinct, weight = 7, 40, 6, 3.0
    words = rng.integers(0, 9, n)
    seen = {(a, b): int(rng.integers(0, 4)) for a in range(n + 1) for b in range(n) if rng.random() < 0.5}
    first, second, count = (np.array(x, np.int64) for x in zip(*[(a, b, c) for (a, b), c in sorted(seen.items())]))
    made = backoff_lm.bigram_automaton(words, (first, second, count), total, distinct, 5, weight)
    sizes = np.array([3, 1, 20, 6])
    tokens = rng.integers(0, n, sizes.sum())
    firsts = np.cumsum(sizes) - sizes
    found = made.walk(n + 1, tokens, firsts)
    for at, token in enumerate(tokens.tolist()):
        before = n if at in firsts else int(tokens[at - 1])
        held = 5 if before == n else int(words[before])
        p = (words[token] + 1) / (total + distinct + 1)
        assert math.isclose(found[at], math.log10((seen.get((before, token), 0) + weight * p) / (held + weight)), rel_tol=1e-12)


def test_a_step_elsewhere_is_an_error():
    made = backoff_lm.bigram_automaton(np.array([1, 2]), (np.array([0]), np.array([1]), np.array([1])), 3, 2, 1, 1.0)
    made.nexts[0] = 2
    with pytest.raises(ValueError):
        made.walk(3, np.array([0, 1]), np.array([0]))
