"""Large groups of near copies: few undecided members need no forests, stars need no component round, and written tables go
when nothing reads them any more."""

from pathlib import Path

import pytest

from scorewright.llm import components, links, minhash_join
from scorewright.session import shared_dir

from tests.llm.test_operators import brute_components
from tests.llm.test_search_and_counts import found, near_copies


def _tables(spark) -> int:
    return sum(1 for p in Path(shared_dir(spark, "tables").removeprefix("file:")).glob("*/*") if p.is_dir())


@pytest.mark.parametrize("exact_bytes", [1 << 20, 0])
def test_undecided_members_by_arrays_or_forests(spark, monkeypatch, exact_bytes):
    forests, forest = [], links._forest
    monkeypatch.setattr(links, "_forest", lambda *a: forests.append(1) or forest(*a))
    for module, name, value in ((minhash_join, "SHORT", 2), (links, "BLOCK", 8), (links, "EXACT_BYTES", exact_bytes)):
        monkeypatch.setattr(module, name, value)
    rows = near_copies()
    got = found(minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85))
    assert got == brute_components(rows, 3, 85)
    assert bool(forests) == (exact_bytes == 0)


def test_stars_take_no_round_and_rounds_leave_one_table(spark, monkeypatch):
    written, materialize = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df: written.append(1) or materialize(df))
    stars = spark.createDataFrame([(100, i) for i in range(101, 130)] + [(7, 8), (8, 8)], "u long, v long")
    got = {r.node: r.component for r in components.components(stars).collect()}
    assert got == {i: 100 for i in range(100, 130)} | {7: 7, 8: 7} and len(written) == 1
    before = _tables(spark)
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    assert {r.component for r in components.components(chain).collect()} == {0}
    assert len(written) > 2 and _tables(spark) == before + 1
    assert components.components(chain.limit(0)).count() == 0
