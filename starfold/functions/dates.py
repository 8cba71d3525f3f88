"""Date columns: calendar parts, day names, weekend flag, day differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col


def iso_weekday(c: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(as_col(c)) + 1


def is_weekend(c: Column | str) -> Column:
    return F.coalesce(iso_weekday(c) >= 6, F.lit(False))


def day_name(c: Column | str, padded: bool = False) -> Column:
    """English day name; ``padded`` gives the blank-padded nine-character form."""
    name = F.date_format(as_col(c), "EEEE")
    return F.rpad(name, 9, " ") if padded else name


def calendar_parts(c: Column | str) -> dict[str, Column]:
    """The columns of the calendar dimension, keyed by their names there."""
    c = as_col(c)
    return {
        "dia": F.dayofmonth(c),
        "mes": F.month(c),
        "trimestre": F.quarter(c),
        "anio": F.year(c),
        "semana": F.weekofyear(c),
        "dia_semana": day_name(c),
        "es_festivo": is_weekend(c),
    }


def add_days(c: Column | str, days: Column | int) -> Column:
    return F.date_add(as_col(c), days.cast("int") if isinstance(days, Column) else days)


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))
