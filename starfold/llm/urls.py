"""URL filter: host and path rules, then a weighted vocabulary found by Aho-Corasick.

One automaton holds all terms, strict and soft. A hit counts where the characters
around it are neither letters nor digits. One strict hit rejects a url, as do
several distinct soft hits. The vocabulary is a parameter of the caller's whose
automaton goes to each task: it is a list of terms, not something that grows with
the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms that reject a url alone.
STRICT = ("adult", "casino", "escort", "hentai", "jackpot", "porn", "sex", "viagra", "warez", "xxx")
#: Terms of which several distinct ones reject a url.
SOFT = ("bet", "bonus", "cheap", "click", "crack", "deal", "download", "free", "loan", "pills", "poker", "promo", "replica",
        "slots", "torrent", "win")
SOFT_HITS = 2
#: Fixed values: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for a null url or one without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule whose host is the url's or a parent of it and whose path begins the url's; its verdict."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [(((host == h) | host.endswith("." + h)) & path.startswith(p), h + p, v) for h, p, v in ranked]
    if not fits:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    pick = lambda at: reduce(lambda c, f: c.when(f[0], f[at]), fits[1:], F.when(fits[0][0], fits[0][at]))
    return pick(1), pick(2)


def _automaton(strict: Sequence[str], soft: Sequence[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):  # a term of both lists is strict
        for term in terms:
            automaton.add_word(term.lower(), (term.lower(), kind))
    automaton.make_automaton()
    return automaton


def _is_word(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at] in "abcdefghijklmnopqrstuvwxyz0123456789"


def hits(automaton, text: str) -> tuple[int, int]:
    """Distinct strict and soft terms at word boundaries of a lower-case text."""
    found = {"strict": set(), "soft": set()}
    for end, (term, kind) in automaton.iter(text):
        if not _is_word(text, end + 1) and not _is_word(text, end - len(term)):
            found[kind].add(term)
    return len(found["strict"]), len(found["soft"])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
          soft: Sequence[str] = SOFT, soft_hits: int = SOFT_HITS) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_strict, n_soft`` per row of ``pages``.

    ``pages`` needs ``page_id`` and ``url``; other columns are not read. The verdict
    is the rule's where one fits, else ``block`` for one strict or ``soft_hits``
    distinct soft terms in the lower-cased url, else ``allow``. A null or empty url
    has no host, path, rule or hit and is allowed. Rows are judged one by one, so
    repeated rows are judged alike, and nothing is shuffled.
    """

    @F.pandas_udf("n_strict int, n_soft int")
    def count(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(strict, soft)
        for batch in urls:
            yield pd.DataFrame([hits(automaton, url) for url in batch], columns=["n_strict", "n_soft"])

    if not strict and not soft:
        raise ValueError("the vocabulary is empty")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("_url"))
    host, path = split_url(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), count(lower_ascii(F.coalesce("_url", F.lit("")))).alias("_hits"))
    rule, ruled = matching_rule(F.col("host"), F.col("path"), rules)
    blocked = (F.col("_hits.n_strict") > 0) | (F.col("_hits.n_soft") >= soft_hits)
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(ruled, F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        F.col("_hits.n_strict").alias("n_strict"), F.col("_hits.n_soft").alias("n_soft"))
