import re

import pytest
from llm_helpers import table, words
from pyspark.sql import functions as F

from starfold.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p.lstrip('0')[:4] or 0) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), order, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


TEXTS = [
    None, "", "mail a.b+c@x-y.example.com. and a@b.c_d@e.f, x@y @z.w a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111  1111 4111111111111112 0000000000000000", "+49 (30) 123456-78 +1 +123 ( + 1234567890 +1234567890123456",
    "\x01\x01a@b.co\x01 1.1.1.1\x01", "éü@x.de 日本a@b.cd \U0001F600 +4915112345678", "+4111 1111 1111 1111 at 1.2.3.4@a.b", "a" * 3000 + " x@y.z",
    "1" * 3000 + ".2.3.4", "a.b" * 1000 + "@c.d", "x@" + "a." * 1000 + "a", "+" + "1(" * 3000, "7 " * 3000,
]


def test_base_spans(spark):
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in pii.find(docs).select("doc_id", pii.digest(F.col("base")).alias("b"), pii.digest(F.col("spans")).alias("s")).collect()}
    for i, text in enumerate(TEXTS):
        assert got[i].b == ",".join(brute(text)) == got[i].s


def test_very_long_runs(spark):
    """Patterns neither recurse nor backtrack over long runs."""
    texts = ["a" * 300_000 + " x@y.z", "1" * 300_000 + ".2.3.4", "x@" + "a." * 150_000 + "a", "+" + "1(" * 150_000, "7 " * 150_000]
    got = {r.doc_id: len(r.base) for r in pii.find(table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 0}


@pytest.fixture(scope="module")
def corpus(spark):
    filler = [(100 + i, f"plain report number {i} about weather over hills", "en", "a") for i in range(60)]
    told = [(i, f"note {i}: the director Zarathustra answers at zara@example.org in {place}", "en", "a")
            for i, place in enumerate(["spring", "summer", "autumn", "winter"])]
    copies = [(200 + i, "Quibblewick wrote from solo@example.org once", "en", "a") for i in range(50)]
    return table(spark, filler + told + copies)


def test_disclosing_terms(corpus):
    got = {r.doc_id: r.s for r in pii.find(corpus).select("doc_id", pii.digest(F.col("spans")).alias("s")).collect()}
    assert all("removed" in got[i] for i in range(4))
    assert all(got[100 + i] == "" for i in range(60)), "clean documents stay"
    assert all(got[200 + i] == "email:23:39" for i in range(50)), "copies of one document are one context"


def test_sanitised_text(corpus):
    got = {r.doc_id: r.text for r in pii.sanitise(corpus).collect()}
    assert "Zarathustra" not in got[0] and "zara@" not in got[0] and "[EMAIL]" in got[0] and "[REMOVED]" in got[0]
    assert got[100] == "plain report number 0 about weather over hills"
    assert got[200] == "Quibblewick wrote from [EMAIL] once"


def test_overlaps_are_hidden_whole(spark):
    text = "call +4111 1111 1111 1111 at 1.2.3.4@a.b now"
    hidden = pii.sanitise(table(spark, [(1, text, "en", "a")])).first().text
    assert hidden == "call [PHONE] at [EMAIL] now" or not re.search(r"[0-9@]", hidden)


def test_edges(odd, empty, odd_rows):
    assert pii.find(odd).count() == len(odd_rows)
    hidden = pii.sanitise(odd)
    assert hidden.columns == odd.columns
    assert sorted(map(str, hidden.collect())) == sorted(map(str, odd.collect()))
    assert pii.find(empty).count() == 0 and pii.sanitise(empty).count() == 0


def spans_of(spark, rows):
    found = pii.find(table(spark, rows)).select("doc_id", pii.digest(F.col("spans")).alias("s"))
    return {r.doc_id: r.s for r in found.collect()}


FILLER = [(1000 + i, words(i, 30), "en", "a") for i in range(200)]


def test_hot_copies_of_a_told_name(spark):
    """Terms, entities and pairs count copies once, so the name of a text copied very often is still told."""
    told = [(i, f"{words(500 + i, 12)} Zarathustra {words(600 + i, 12)} zara@example.org {words(700 + i, 12)}", "en", "a") for i in range(3)]
    copies = [(5000 + i, told[0][1], "en", "a") for i in range(3000)]
    near = [(9000 + i, told[1][1] + f" end{i}", "en", "a") for i in range(20)]
    got = spans_of(spark, FILLER + told + copies + near)
    assert all("removed" in got[i] for i in (0, 1, 2, 5000, 7999, 9000, 9019))
    assert not any(got[1000 + i] for i in range(200))


def test_near_copies_and_repeats_are_one_document(spark):
    near = [(i, f"Quibblewick {words(800, 60)} solo@example.org copy{i}", "en", "a") for i in range(30)]
    thrice = [(100, " ".join(f"Humperdinck {words(900 + i, 20)} once@example.org {words(950 + i, 20)}" for i in range(3)), "en", "a")]
    got = spans_of(spark, FILLER + near + thrice)
    assert not any("removed" in got[i] or "term" in got[i] for i in [*range(30), 100])


def test_signature_far_from_a_short_name(spark):
    """Independent documents that name the address in the same words, with the name far away and short."""
    told = [(i, f"Dear Lee, {words(300 + i, 60)} please write to lee7@example.org for further details", "en", "a") for i in range(4)]
    got = spans_of(spark, FILLER + told)
    assert all("removed:5:8" in got[i] for i in range(4))


def test_levels_against_brute_force(spark):
    """Every level follows from p(t, e) / (p(t) p(e)) over documents, counted plainly."""
    import math
    import random

    pick, rows, held, terms = random.Random(11), [], {}, {}
    letters = lambda n: "".join(pick.choice("abcdefgh") for _ in range(n))
    names, common = [letters(9) for _ in range(12)], [letters(5) for _ in range(30)]
    for i in range(400):
        own = [letters(14) for _ in range(25)] + pick.sample(common, 8)
        entity = f"box{i % 8}@host.example.org" if i % 5 < 2 else None
        if entity:
            own += [names[i % 8]] * (pick.random() < 0.9) + [names[8 + i % 4]] * (pick.random() < 0.5)
        elif pick.random() < 0.02:
            own.append(names[pick.randrange(12)])
        pick.shuffle(own)
        rows.append((i, " ".join(own + [entity] * (entity is not None)), "en", "a"))
        held[i] = {entity} - {None}
        terms[i] = set(own) | set(re.findall("[a-z]{2,}", entity or ""))
    expected, n = {}, len(rows)
    for entity in set().union(*held.values()):
        with_e = [i for i in held if entity in held[i]]
        own = math.log(n / len(with_e))
        for term in set().union(*(terms[i] for i in with_e)):
            both, n_t = sum(term in terms[i] for i in with_e), sum(term in t for t in terms.values())
            share = math.log(both * n / (n_t * len(with_e))) / own
            if both >= pii.SUPPORT and share >= pii.GENERALISE:
                expected[entity, term] = "removed" if share >= pii.REMOVE else "term"
    found = pii.disclosing_terms(pii._with_spans(table(spark, rows)))
    assert {(r.value, r.term): r.level for r in found.collect()} == expected
    assert set(expected.values()) == {"removed", "term"} and {t for _, t in expected} & set(names[:8])
