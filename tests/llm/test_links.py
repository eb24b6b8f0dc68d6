"""The block tasks of large groups, without a session: what they keep, against all pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from scorewright.llm import links

PERCENT = 85
TYPES = ["sig", "i", "j", "node", "n", "component", "block", "least", "s"]


class _Sent:
    def __init__(self, value):
        self.value = value


def members(seed: int, blocks: int):
    """Random sets near the threshold in one group, over one or two blocks, some in one component already."""
    rng = np.random.RandomState(seed)
    base = np.unique(rng.randint(0, 2 ** 62, 260).astype(np.uint64))
    sets = []
    for _ in range(40):
        swap = rng.randint(0, 40)
        sets.append(np.unique(np.r_[rng.permutation(base)[: len(base) - swap], rng.randint(0, 2 ** 62, swap).astype(np.uint64)]))
    n = len(sets)
    component = np.where(rng.rand(n) < 0.4, 3, np.arange(n))
    table = pa.table({
        "sig": pa.array([7] * n, pa.int64()), "i": pa.array([0] * n, pa.int32()), "j": pa.array([blocks - 1] * n, pa.int32()),
        "node": pa.array(range(n), pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64()), "component": pa.array(component, pa.int64()),
        "block": pa.array(np.arange(n) % blocks, pa.int32()), "least": pa.array([[7]] * n, pa.list_(pa.int64())), "s": pa.array([0] * n, pa.int64()),
        "grams": pa.array([links.fine_bitmap(s) for s in sets], pa.binary())})
    return sets, component, table


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("blocks", [1, 2])
def test_undecided_keeps_every_open_link(seed, blocks):
    sets, component, table = members(seed, blocks)
    asked = [(a, b) for a in range(40) for b in range(a + 1, 40) if component[a] != component[b] and (blocks == 1 or a % 2 != b % 2)]
    both = {p: len(np.intersect1d(sets[p[0]], sets[p[1]])) for p in asked}
    total = {p: len(sets[p[0]]) + len(sets[p[1]]) for p in asked}
    linked = {p for p in asked if 100 * both[p] >= PERCENT * (total[p] - both[p])}
    may = set()
    for p in asked:
        most = (total[p] - links.fine_differ(*(table.column("grams")[x].as_py() for x in p))) // 2
        if 100 * most >= PERCENT * (total[p] - most):
            may.add(p)
    assert linked <= may
    key = tuple(pa.scalar(x) for x in (7, 0, blocks - 1))
    everyone = lambda sketch, n, a, r: np.ones(len(r), bool)
    for refuted in (set(), may - linked, may):
        run = links._undecided(["s"], everyone, PERCENT, _Sent(refuted), TYPES)
        got = run(key, table)
        assert got.column_names == TYPES
        assert sorted(got.column("node").to_pylist()) == sorted({x for p in may - refuted for x in p})
        forest = links._forest(["s"], everyone, PERCENT, _Sent(refuted))(key, table)
        pairs = set(zip(*(forest.column(c).to_pylist() for c in "uv"), strict=True))
        assert pairs <= may - refuted and len(pairs) < 40
