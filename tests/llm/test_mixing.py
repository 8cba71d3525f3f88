from collections import Counter, defaultdict

import pytest
from llm_helpers import table, words

from starfold.llm import mixing


def water_level(sizes, weights, share, cap):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, share * sum(sizes.values())
    while True:
        rest, w = total - sum(fixed.values()), sum(weight[s] for s in names if s not in fixed)
        over = [s for s in names if s not in fixed and rest * weight[s] / w > cap * sizes[s]]
        if not over:
            return fixed | {s: rest * weight[s] / w for s in names if s not in fixed}
        fixed |= {s: cap * sizes[s] for s in over}


def test_targets_and_takes(spark):
    rows = [(i, words(i, 1 + i * 37 % 90), "en", s) for i in range(600) for s in [["a", "b", "c", None, "tiny"][min(4, i % 5 if i < 550 else 4) if i % 3 else 0]]]
    got = mixing.mix(table(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    targets = water_level(sizes, (3, 1, 2), 1.5, 2)
    taken, longest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in sizes)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(table(spark, rows)).collect()), key=str)


def test_one_source_holds_nearly_all(spark):
    sizes = {"big": 10_000, "small": 10}
    rows = spark.createDataFrame([("big", 10_000), ("small", 10)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.target_sizes(rows).collect()}
    assert got == {s: pytest.approx(t) for s, t in water_level(sizes, (3, 1, 2), 1.5, 2).items()}


def test_edges(odd, empty, odd_rows):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).columns == empty.columns
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r.copies for r in got)
    assert set(map(str, rows.collect())) <= set(map(str, odd.collect()))
