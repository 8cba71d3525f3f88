from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starfold.functions import dates, numbers, text
from starfold.sources import inline_table


def column(spark, values, kind, expression):
    df = inline_table(spark, [(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_padding(spark):
    assert column(spark, [7, 12345, None], "int", text.zero_pad("v", 3)) == ["007", "12345", None]
    assert column(spark, [7, 12345, None], "int", text.fixed_pad("v", 3)) == ["007", "123", None]
    numbers = [10**6, 10**6 + 1, 10**8, 10**8 + 1, 10**10]
    assert len(set(column(spark, numbers, "bigint", text.zero_pad("v", 6)))) == len(numbers)


def test_title_case_and_trim(spark):
    assert column(spark, ["  ANA LOPEZ ", None], "string", text.title_case("v")) == ["Ana Lopez", None]
    assert column(spark, ["\t x y\n"], "string", text.trim_all("v")) == ["x y"]


def test_map_values_keeps_unmapped_and_null(spark):
    assert column(spark, ["a", "b", None], "string", text.map_values("v", {"a": "A"})) == ["A", "b", None]
    assert column(spark, ["a", "b", None], "string", text.map_values("v", {"a": 1}, default=F.lit(0))) == [1, 0, None]


def test_canonical_leaves_unknown_untouched(spark):
    spellings = {"Sevilla": ["sevilla", "sevila"]}
    assert column(spark, [" SEVILA ", " Oviedo ", None], "string", text.canonical("v", spellings)) == ["Sevilla", " Oviedo ", None]


def test_vocabulary_keeps_valid_value_untrimmed(spark):
    got = column(spark, [None, "", "Granizo", " Sol "], "string", text.in_vocabulary("v", ["Sol"], "Desconocido"))
    assert got == ["Desconocido", "Desconocido", "Desconocido", " Sol "]


def test_rounding_goes_away_from_zero(spark):
    values = [Decimal("2.345"), Decimal("-2.345")]
    assert column(spark, values, "decimal(10,3)", numbers.rounded(F.col("v"), 2)) == [Decimal("2.35"), Decimal("-2.35")]


def test_safe_ratio_with_zero_and_null(spark):
    got = column(spark, [2, 0, None], "int", numbers.safe_ratio(F.lit(1), "v"))
    assert got == [0.5, None, None]


def test_sensor_expressions(spark):
    assert column(spark, [-99, 5, None], "int", numbers.sentinel_to_null("v", -99)) == [None, 5, None]
    assert column(spark, [-3, -99, 2, None], "int", numbers.negative_to_zero("v")) == [0, 0, 2, None]
    assert column(spark, [-1, 0, 100, 101, None], "int", numbers.outside_to_null("v", 0, 100)) == [None, 0, 100, None, None]


def test_ordered_pair(spark):
    df = inline_table(spark, [(20, 5), (5, 20), (None, 3), (7, None)], "lo int, hi int")
    low, high = numbers.ordered_pair("lo", "hi")
    assert [tuple(r) for r in df.select(low, high).collect()] == [(5, 20), (5, 20), (None, 3), (7, None)]


@pytest.mark.parametrize("value, expected", [
    (None, "Desconocida"), ("-0.1", "Muy fria"), ("0", "Fria"), ("9.9", "Fria"), ("10", "Templada"),
    ("19.9", "Templada"), ("20", "Calurosa")])
def test_temperature_bands(spark, value, expected):
    from starfold.plans.weather import HOT, TEMPERATURE_BANDS, UNKNOWN_BAND

    value = None if value is None else Decimal(value)
    got = column(spark, [value], "decimal(5,1)", numbers.band("v", TEMPERATURE_BANDS, HOT, UNKNOWN_BAND))
    assert got == [expected]


def test_number_text(spark):
    values = [Decimal("4627.10"), Decimal("85000.00"), Decimal("-0.05"), None]
    assert column(spark, values, "decimal(12,2)", numbers.number_text("v", 2)) == ["4627.1", "85000.0", "-0.05", None]
    percent = [Decimal("69.8309000000"), Decimal("71.1596083705")]
    assert column(spark, percent, "decimal(18,10)", numbers.number_text("v", 10, symbol=",")) == ["69,8309", "71,1596083705"]
    assert column(spark, values[1:2], "decimal(12,2)", numbers.number_text("v", 2, min_decimals=0)) == ["85000"]


def test_locale_number(spark):
    got = column(spark, ["1.234,50", "-7", "x", None], "string", numbers.locale_number("v", "decimal(10,2)"))
    assert got == [Decimal("1234.50"), Decimal("-7.00"), None, None]


def test_dates(spark):
    day = F.col("v").cast("date")
    assert column(spark, ["2024-02-03", "2024-02-05"], "string", dates.is_weekend(day)) == [True, False]
    assert column(spark, ["2024-02-05"], "string", dates.day_name(day)) == ["Monday"]
    assert column(spark, ["2024-02-05"], "string", dates.day_name(day, padded=True)) == ["Monday   "]
    assert column(spark, ["2024-12-30"], "string", dates.calendar_parts(day)["semana"]) == [1]
    assert column(spark, ["2024-02-05"], "string", dates.days_between(F.lit("2024-03-01").cast("date"), day)) == [-25]
