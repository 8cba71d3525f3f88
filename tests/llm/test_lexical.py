import math
import re

import pytest
from llm_helpers import table, words

from starfold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    texts = [terms(t) for _, t in docs]
    n_docs, length = sum(bool(t) for t in texts), sum(map(len, texts))
    out = []
    for item, text in items:
        scores = []
        for (doc, _), own in zip(docs, texts):
            total = 0
            for term in terms(text):
                tf, df = own.count(term), sum(term in t for t in texts)
                if tf:
                    m = 25 + 75 * len(own) * n_docs // length
                    total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if total:
                scores.append((-total, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:top], 1)]
    return out


def item_table(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, score int, rank string")


def got(docs, items, **more):
    return sorted(map(tuple, lexical.search(docs, items, **more).collect()), key=str)


ITEMS = [(1, words(900, 12, 60)), (2, words(901, 5, 60) + " the THE"), (3, "Ünï é x ascii-word; w1_w2"), (4, None), (5, " .,"), (5, "w3 w3 w3"), (None, "w4")]


@pytest.mark.parametrize("block, documents", [(1024, 512), (2, 3)])
def test_against_brute_force(spark, monkeypatch, block, documents):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    monkeypatch.setattr(lexical, "DOCUMENTS", documents)
    rows = [(i, words(i, 3 + i % 40, 60) + (" The" * (i % 3)), "en", "a") for i in range(120)]
    rows += [(200 + i, rows[5][1], "en", "a") for i in range(15)] + [(300, "w1_w2 ünï Ünï É é x", "de", "b"), (None, "w4 w4", "de", "b"), (300, "W1w2 w4", None, None)]
    expected = brute([(i, t) for i, t, _, _ in rows], ITEMS)
    assert got(table(spark, rows), item_table(spark, ITEMS)) == sorted(expected, key=str)


def test_edges(spark, odd, empty, odd_rows):
    items = [(1, "the same of it w1 w2"), (2, "a"), (3, "id text ünïcödé ß endoftext x1c"), (4, "nowhere")]
    assert got(odd, item_table(spark, items)) == sorted(brute([(i, t) for i, t, _, _ in odd_rows], items), key=str)
    assert got(empty, item_table(spark, items)) == [] == got(odd, item_table(spark, []))
    assert got(odd, item_table(spark, [(1, None), (2, "")])) == []
    assert {r[1] for r in got(odd, item_table(spark, items), top=2)} == {1, 2}
