"""The prefix tree of the n-gram join against all pairs."""

import numpy as np
import pytest

from courtside.llm.ngram_join import PERCENT, trie_links


def parts(ids, links):
    """The smallest id that each one reaches."""
    lowest = {i: i for i in ids}
    while True:
        before = dict(lowest)
        for a, b in links:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
        if lowest == before:
            return lowest


def all_links(sets):
    return [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if 100 * len(set(a) & set(b)) >= PERCENT * len(set(a) | set(b))
    ]


def run(sets):
    seen = {}
    ids = np.arange(len(sets))
    arrays = [np.array(sorted(x), np.int64) for x in sets]
    return parts(ids.tolist(), trie_links(ids, arrays, seen)), seen


def changed(draw, base, n, most):
    """A copy with up to n members exchanged, and some left out."""
    left = set(base) - set(draw.permutation(sorted(base))[: draw.integers(0, n + 1)].tolist())
    return left | set(draw.integers(0, most, draw.integers(0, n + 1)).tolist())


@pytest.mark.parametrize("seed", range(12))
def test_equal_to_all_pairs(seed):
    draw = np.random.default_rng(seed)
    most = int(draw.choice([30, 200, 5000]))
    bases = [set(draw.integers(0, most, draw.integers(1, 60)).tolist()) for _ in range(8)]
    sets = [changed(draw, bases[draw.integers(0, 8)], int(draw.choice([1, 4, 9])), most) or {0} for _ in range(120)]
    sets = [set(x) for x in dict.fromkeys(frozenset(x) for x in sets)]  # equal sets stand as one
    assert run(sets)[0] == parts(range(len(sets)), all_links(sets))


def test_sets_one_below_and_at_the_threshold():
    base = set(range(100, 170))
    at, below = base | set(range(12)) | {500}, base | set(range(24))
    assert run([base, at])[0] == {0: 0, 1: 0}  # 70 of 83
    assert run([base, below])[0] == {0: 0, 1: 1}  # 70 of 94
    assert run([set(range(3)), set(range(4))])[0] == {0: 0, 1: 0}  # exactly 3 of 4


def test_nested_starts():
    sets = [set(range(n)) for n in range(1, 60)]
    assert run(sets)[0] == parts(range(len(sets)), all_links(sets))


def test_subtrees_are_left_unseen():
    """Sets with a common start whose rests are too short for any other set."""
    common = set(range(5))
    # 40 members of their own, and 10 that each shares with a set of another common start.
    one = [common | set(range(1000 + 50 * i, 1050 + 50 * i)) for i in range(40)]
    two = [set(range(10, 15)) | set(range(1000 + 50 * i, 1010 + 50 * i)) | set(range(9000 + 40 * i, 9040 + 40 * i)) for i in range(40)]
    found, seen = run(one + two)
    assert len(set(found.values())) == 80 and seen == {"left": 80}


def test_a_crowd_of_copies_is_left_once_joined():
    draw = np.random.default_rng(7)
    base = set(range(80))
    sets = [set(x) for x in dict.fromkeys(frozenset(changed(draw, base, 3, 4000)) for _ in range(300))]
    found, seen = run(sets)
    assert set(found.values()) == {0} and seen["compared"] < 20


def test_one_set_and_sets_without_common_members():
    assert run([{1, 2}])[0] == {0: 0}
    assert run([{1}, {2}, {3}])[0] == {0: 0, 1: 1, 2: 2}
