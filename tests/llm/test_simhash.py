import random

import numpy as np
import pytest
from llm_helpers import table, words

from starfold.llm import simhash
from starfold.llm.components import components


def brute(prints, bits=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def plain_fingerprint(text):
    import re

    import xxhash

    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("text", [None, "", "One", "one TWO three", "a b c d", "a b c d e a b c d e", "É À ß Ä", words(3, 500), "x\x1cy\x85z a b c"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def clustered(n, seed):
    pick = random.Random(seed)
    out = []
    for _ in range(n // 6):
        centre = pick.getrandbits(64)
        for _ in range(6):
            flipped = centre
            for bit in pick.sample(range(64), pick.randrange(6)):
                flipped ^= 1 << bit
            out.append(flipped)
    return sorted(set(out))


@pytest.mark.parametrize("shards", [1, 2, 16])
def test_tree_finds_every_link(shards):
    prints = clustered(1500, 5)
    points = np.array(prints, np.uint64)
    tree, _ = simhash.fit(points[::3], shards)
    forest = simhash.Forest(len(points))
    for _, at, home in simhash.deal(tree, points, 4):
        label = simhash.shard_forest(points[at], home)
        forest.link(at, at[label])
    expected = brute(prints)
    by_label = {}
    for mine, theirs in zip(forest.label.tolist(), expected):
        assert by_label.setdefault(mine, theirs) == theirs
    assert len(by_label) == len(set(expected))


@pytest.mark.parametrize("rows, shards", [(50, 1), (50, 4), (7, 2), (10**6, 8)])
def test_blocks_find_every_link(monkeypatch, rows, shards):
    """However shards are split, blocks are bounded and each pair meets once with a home in it."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", rows)
    prints = clustered(600, 9)
    points = np.array(prints, np.uint64)
    tree, _ = simhash.fit(points[::2], shards)
    dealt = simhash.deal(tree, points, 4)
    sizes = {}
    for leaf, at, home in dealt:
        sizes[leaf], sizes[~leaf] = int(home.sum()), int((~home).sum())
    blocks, forest, seen, met = simhash.Blocks(sizes), simhash.Forest(len(points)), set(), {}
    for leaf, at, home in dealt:
        of_point, index, at_home = blocks.of(leaf, points[at], home)
        for block in np.unique(of_point).tolist():
            own, as_home = index[of_point == block], at_home[of_point == block]
            assert block not in seen and len(own) <= 4 * rows and len(np.unique(own)) == len(own)
            seen.add(block)
            label = simhash.shard_forest(points[at[own]], as_home, among_homes=blocks.among_homes(block))
            forest.link(at[own], at[own[label]])
            if leaf == dealt[0][0]:
                for i in own[as_home]:
                    for j in own if blocks.among_homes(block) else own[~as_home]:
                        met[int(i), int(j)] = met.get((int(i), int(j)), 0) + 1
    assert set(met.values()) <= {1}
    expected, by_label = brute(prints), {}
    for mine, theirs in zip(forest.label.tolist(), expected):
        assert by_label.setdefault(mine, theirs) == theirs
    assert len(by_label) == len(set(expected))


def test_components(spark):
    pick = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(pick.randrange(2000, 2400), pick.randrange(2000, 2400)) for _ in range(250)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    expected = {}
    for a, b in links:
        ra, rb = expected.setdefault(a, a), expected.setdefault(b, b)
        low = min(ra, rb)
        expected = {k: low if v in (ra, rb) else v for k, v in expected.items()}
    assert got == {k: v for k, v in expected.items() if any(k in l and l[0] != l[1] for l in links)}


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SPREAD", 1)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 10)
    base = [words(i, 300, 5000) for i in range(60)]
    near = [t.rsplit(" ", 1)[0] + f" changed{i}" for i, t in enumerate(base[:20])]
    rows = [(i, t, "en", "a") for i, t in enumerate(base + near + base[:5] * 40)]
    got = sorted((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(table(spark, rows)).collect())
    prints = [simhash.fingerprint(t) for _, t, _, _ in rows]
    assert [r[1] % 2**64 for r in got] == prints
    assert [r[2] for r in got] == brute(prints)
    kept = {r.doc_id for r in simhash.keep_one(table(spark, rows)).collect()}
    assert kept == set(brute(prints))


def test_edges(odd, empty, odd_rows):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    blank = [r for r in got if r.fp == 0]
    assert len(blank) == 4 and {r.component_id for r in blank} == {1}
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({r.root for r in got})
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
