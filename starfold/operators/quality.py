"""Declarative data-quality rules, evaluated as batch jobs.

Row rules (not null, checks, domains, lengths, date order, arithmetic) of a table
run together in one scan. Unique and foreign-key rules need a shuffle each. As in
SQL, a check whose result is unknown passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import flag
from .joins import any_null
from .lookup import orphans


@dataclass(frozen=True)
class RowRule:
    """``bad`` marks a violating row, ``value`` is what the report shows."""

    name: str
    bad: Column
    value: Column


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null:{column}", F.col(column).isNull(), F.lit(None).cast("string"))


def _rule(name: str, holds: Column, value: Column) -> RowRule:
    return RowRule(name, ~F.coalesce(holds, F.lit(True)), value.cast("string"))


def check(name: str, holds: Column, value: Column) -> RowRule:
    """A condition that must not be false; NULL passes."""
    return _rule(f"check:{name}", holds, value)


def in_range(column: str, low: float | None = None, high: float | None = None, open_low: bool = False) -> RowRule:
    c = F.col(column)
    holds = F.lit(True)
    if low is not None:
        holds = holds & (c > low if open_low else c >= low)
    if high is not None:
        holds = holds & (c <= high)
    return _rule(f"range:{column}", holds, c)


def in_domain(column: str, allowed: Sequence) -> RowRule:
    return _rule(f"domain:{column}", F.col(column).isin(*allowed), F.col(column))


def not_before(later: str, earlier: str, strict: bool = False) -> RowRule:
    a, b = F.col(later), F.col(earlier)
    return _rule(f"order:{earlier}<{later}" if strict else f"order:{earlier}<={later}", a > b if strict else a >= b, a)


def max_length(column: str, length: int) -> RowRule:
    return _rule(f"length:{column}", F.length(column) <= length, F.col(column))


@dataclass(frozen=True)
class Unique:
    columns: Sequence[str]


@dataclass(frozen=True)
class ForeignKey:
    columns: Sequence[str]
    ref: DataFrame = field(hash=False, compare=False)
    ref_columns: Sequence[str] = ()


def _text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def row_violations(df: DataFrame, key: Sequence[str], rules: Sequence[RowRule]) -> DataFrame:
    """(rule, key, value) of each broken row rule; the table is scanned once for all rules."""
    found = F.array_compact(
        F.array(*[F.when(r.bad, F.struct(F.lit(r.name).alias("rule"), r.value.alias("value"))) for r in rules])
    )
    return df.select(_text(key).alias("key"), F.inline(found)).select("rule", "key", "value")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys are never duplicates."""
    return repeated_keys(key_counts(df, columns), columns)


def key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``n`` rows per key without NULL."""
    return df.filter(~any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def repeated_keys(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The report of :func:`duplicate_keys` from counts per key."""
    return counts.filter("n > 1").select(
        F.lit(f"unique:{','.join(columns)}").alias("rule"), _text(columns).alias("key"), F.col("n").cast("string").alias("value")
    )


def missing_parents(df: DataFrame, key: Sequence[str], fk: ForeignKey) -> DataFrame:
    """Rows whose non-NULL reference has no parent."""
    pairs = dict(zip(fk.columns, fk.ref_columns or fk.columns))
    lost = orphans(df.filter(~any_null(fk.columns)), fk.ref, pairs)
    return lost.select(
        F.lit(f"foreign_key:{','.join(fk.columns)}").alias("rule"), _text(key).alias("key"), _text(fk.columns).alias("value")
    )


def rule_reports(df: DataFrame, key: Sequence[str], rules: Sequence[RowRule | Unique | ForeignKey]) -> list[DataFrame]:
    """Violations as (rule, key, value): one report for all row rules, one for each unique and foreign key."""
    reports = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        reports.append(row_violations(df, key, row_rules))
    reports += [duplicate_keys(df, r.columns) for r in rules if isinstance(r, Unique)]
    reports += [missing_parents(df, key, r) for r in rules if isinstance(r, ForeignKey)]
    return reports


def validate(df: DataFrame, key: Sequence[str], rules: Sequence[RowRule | Unique | ForeignKey]) -> DataFrame:
    """All violations as (rule, key, value)."""
    reports = rule_reports(df, key, rules)
    if not reports:
        raise ValueError("no rules given")
    return reduce(DataFrame.unionByName, reports)


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of the named columns with their declared default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


__all__ = [
    "ForeignKey", "RowRule", "Unique", "apply_defaults", "check", "duplicate_keys", "flag", "in_domain", "in_range",
    "max_length", "missing_parents", "not_before", "not_null", "row_violations", "rule_reports", "validate",
]
