"""The search of bin completion: dominance, bounded memory, restored counts."""

import random
import tracemalloc
from collections import Counter
from itertools import combinations

import pytest

from sensitext.llm.packing import _Search, best_fit, bin_completion, lower_bound


def sums_of(filling):
    """Sums of two or more pieces."""
    return {sum(c) for n in range(2, len(filling) + 1) for c in combinations(filling, n)}


@pytest.mark.parametrize("seed", range(20))
def test_fillings_are_whole_and_undominated(seed):
    """All maximal fillings come, but for those in which a piece left over could stand for others."""
    rng = random.Random(seed)
    counts = Counter(rng.randrange(2, 12) for _ in range(9))
    room = rng.randrange(5, 30)
    search = _Search(counts, 30, 1 << 20)
    found = {tuple(sorted(f, reverse=True)): spare for f, spare in search.fillings(room)}
    assert search.left == [counts[k] for k in range(31)]
    items = list(counts.elements())
    maximal = set()
    for n in range(len(items) + 1):
        for c in combinations(items, n):
            rest = Counter(items) - Counter(c)
            if sum(c) <= room and all(k > room - sum(c) for k in rest):
                maximal.add(tuple(sorted(c, reverse=True)))
    assert set(found) <= maximal
    for filling in maximal:
        spare = room - sum(filling)
        rest = Counter(items) - Counter(filling)
        better = any(x <= y <= x + spare for x in sums_of(filling) for y in rest) or any(
            x < y <= x + spare for x in filling for y in rest
        )
        if not better:
            assert found[filling] == spare
    for filling, spare in found.items():
        rest = Counter(items) - Counter(filling)
        assert not any(x < y <= x + spare for x in filling for y in rest)


def test_search_holds_little_whatever_its_length():
    rng = random.Random(3)
    counts = Counter(min(4096, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(60_000))
    assert len(counts) > 3000
    tracemalloc.start()
    packing = bin_completion(dict(counts), 4096)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    held = Counter()
    for fill, times in packing:
        assert sum(k * n for k, n in fill) <= 4096
        held.update({k: n * times for k, n in fill})
    assert held == counts
    packed, greedy = (sum(t for _, t in p) for p in (packing, best_fit(counts, 4096)))
    assert lower_bound(counts, 4096) <= packed <= greedy


def test_pieces_of_many_to_a_sequence_are_searched_too():
    """Sequences of far more than five pieces reach the bound where best fit does not."""
    counts = {7: 300, 11: 200, 13: 170, 5: 90}
    limit = 128
    n = sum(t for _, t in bin_completion(counts, limit))
    assert n == lower_bound(counts, limit)
