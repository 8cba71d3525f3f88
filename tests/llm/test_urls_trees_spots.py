import math

import numpy as np
import oracle
import pytest
from llm_helpers import table, words

from starfold.llm import kmtree, spotsigs, urls
from starfold.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) is None


URLS = [
    (1, None, "", "", None, "allow"), (2, "no scheme casino", "", "", None, "block"), (3, "", "", "", None, "allow"),
    (4, "HTTP://WWW.Example.COM/en/x?casino#1", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    (5, "http://blog.example.com/en/", "blog.example.com", "/en/", "example.com/en/", "block"),
    (6, "http://example.com/EN/", "example.com", "/EN/", "com/", "allow"), (7, "http://a.com", "a.com", "", None, "allow"),
    (8, "http://a.com?porn", "a.com", "", None, "block"), (9, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    (10, "http://net/es/", "net", "/es/", "net/es/", "block"), (11, "http://a.net/fr/x", "a.net", "/fr/x", "net/fr/", "block"),
    (12, "http://casinos.org/essex/", "casinos.org", "/essex/", None, "allow"), (13, "http://x.org/free-free-free", "x.org", "/free-free-free", None, "allow"),
    (14, "http://x.org/free_bonus", "x.org", "/free_bonus", None, "block"), (15, "a://b://c/d", "b:", "//c/d", None, "allow"),
    (16, "http://x.org#xxx", "x.org", "", None, "block"), (None, "http://sex.org/", "sex.org", "/", None, "block"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u, *_ in URLS], "page_id bigint, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert got == {i: tuple(rest) for i, _, *rest in URLS}
    assert urls.judge(pages.limit(0)).count() == 0
    assert urls.judge(pages.union(pages)).count() == 2 * len(URLS)
    assert set(r.rule for r in urls.judge(pages, rules=()).collect()) == {None}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, leaf int, v int")


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(kmtree, "LEAF", 40)
    monkeypatch.setattr(kmtree, "PART", 50)
    random = np.random.default_rng(1)
    centres = random.normal(size=(12, 16))
    points = (centres[random.integers(0, 12, 1500)] + 0.6 * random.normal(size=(1500, 16))).astype(np.float32)
    points[1000:1400] = points[0]  # one vector very often
    rows = [(i, p.tolist(), 0, 1, 2) for i, p in enumerate(points)]
    found, measured = kmtree.search(vectors(spark, rows), "vec_id % 20 = 0")
    assert measured["visits"] < measured["leaves"]
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    exact, hits = points.astype(float), 0
    for q in range(0, 1500, 20):
        score = kmtree.inner_products(np.repeat(exact[q:q + 1], 1500, 0), exact)
        own = [(i, s) for i, s in got[q]]
        assert len(own) == 20 and all(score[i] == s for i, s in own) and own == sorted(own, key=lambda x: (-x[1], x[0]))
        true = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        hits += len(set(true) & {i for i, _ in own})
    assert hits / (75 * 20) >= 0.9


def test_small_leaf_is_not_the_end(spark, monkeypatch):
    """A query in a leaf of few vectors, some of them its own rows, goes on until its answer is full."""
    tree = kmtree.Tree(np.array([[0.0, 9.0, 0.0], [9.0, 0.0, 0.0]]), [kmtree.Tree(leaf=0), kmtree.Tree(leaf=1)])
    monkeypatch.setattr(kmtree, "fit", lambda sample, leaves: (tree, 2))
    monkeypatch.setattr(kmtree, "_calibrate", lambda *a: (1, 1.0))
    rows = [(0, [0.0, 9.0], 0, 1, 2)] * 25 + [(i, [0.0, 9.0], 0, 1, 2) for i in (1, 2)] + [(i, [9.0, i / 100], 0, 1, 2) for i in range(10, 60)]
    got = kmtree.search(vectors(spark, rows), "vec_id = 0")[0].orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, *range(59, 41, -1)]


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, 1, 1), (20, [1.0, 0.0], 1, 1, 1), (20, [1.0, 0.0], 1, 1, 1), (3, [0.0, 0.0], 1, 1, 1), (40, None, 1, 1, 1), (5, [nan, 1.0], 1, 1, 1),
            (6, [1.0, None], None, 1, 1), (7, [inf, 1.0], 1, 1, 1), (None, [1.0, 1.0], 1, 1, 1), (8, [2.0, 1.0], 1, 1, 1), (9, [1.0, 2.0, 3.0], 1, 1, 1), (60, [], 1, 1, 1)]
    got = sorted(map(tuple, kmtree.search(vectors(spark, rows), "vec_id % 20 = 0")[0].collect()))
    assert got == [(0, 1, 8, 2.0), (0, 2, 20, 1.0), (0, 3, 20, 1.0), (20, 1, 8, 2.0), (20, 2, 0, 1.0)]
    assert kmtree.search(vectors(spark, rows[:0]) if rows[:0] else vectors(spark, rows).limit(0), "vec_id % 20 = 0")[0].count() == 0


def plain_signatures(text):
    import hashlib
    import re

    anchors = {w for own in spotsigs.ANCHORS.values() for w in own}
    found = re.findall(r"[^\W_]+", (text or "").lower())
    spots = set()
    for i, word in enumerate(found):
        if word in anchors:
            chain = []
            for follower in found[i + 1:i + 1 + spotsigs.CHAIN]:
                if follower in anchors:
                    break
                chain.append(follower)
            if chain:
                spots.add(" ".join([word, *chain]))
    spots = spots or ({" ".join(found)} if found else set())
    return sorted({hashlib.md5(s.encode()).hexdigest()[:8] for s in spots})


def test_signatures(spark, odd, odd_rows, sf_dir):
    texts = [t for _, t, _, _ in odd_rows] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    from pyspark.sql import functions as F

    got = {r.doc_id: r.s for r in docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_signatures(t) for t in texts]


def jaccard(a, b):
    return 1.0 if not a and not b else len(set(a) & set(b)) / len(set(a) | set(b))


def test_edits_over_buckets(spark, monkeypatch, odd, odd_rows, empty):
    import hashlib

    monkeypatch.setattr(spotsigs, "BUCKET_ROWS", 2)
    rows = {i: t or "" for i, t in [(3 * i, words(i, 40) + " the end of it") for i in range(17)] + [(100, None), (101, "")]}
    docs = table(spark, [(i, t or None, "en", "a") for i, t in rows.items()])
    order = sorted(rows, reverse=True)
    got = {r.doc_id: r for r in spotsigs.compare_with_edits(docs).collect()}
    for i, following in zip(order, order[1:] + order[:1]):
        text, third = rows[i], len(rows[i]) // 3
        edited = text[:len(text) - third] + rows[following][:third]
        mine, changed, other = plain_signatures(text), plain_signatures(edited), plain_signatures(rows[following])
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == "".join(mine) and got[i].edited_fingerprint == "".join(changed)
        assert got[i].near_edited == pytest.approx(jaccard(mine, changed)) and got[i].near_next == pytest.approx(jaccard(mine, other))
    assert spotsigs.compare_with_edits(odd).count() == len(odd_rows)
    assert spotsigs.compare_with_edits(empty).count() == 0
    single = spotsigs.compare_with_edits(table(spark, [(1, "the cat of one", "en", "a")])).first()
    assert single.near_next == 1.0


def test_near_duplicates(spark, odd, odd_rows, empty):
    base = [" ".join(f"the {w} {w}x {w}y" for w in words(i, 30, 2000).split()) for i in range(25)]
    near = [t.rsplit(" ", 3)[0] for t in base[:10]]
    texts = base + near + base[:2] * 30 + ["", None]
    got = {r.doc_id: r.class_id for r in spotsigs.near_duplicates(table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    sets = [plain_signatures(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [got[i] for i in range(len(texts))] == label
    assert spotsigs.near_duplicates(odd).count() == len(odd_rows)
    assert spotsigs.near_duplicates(empty).count() == 0 and not math.isnan(0.0)
