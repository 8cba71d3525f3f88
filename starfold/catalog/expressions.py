"""Scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..functions.numbers import dec, money
from .registry import Source, query
from .sql import scaled

_SALDO = "CAST(c_acctbal AS DECIMAL(12,2))"


@query("f1_f2_codes", """SELECT c_custkey, 'CLI-' || lpad(CAST(c_custkey AS VARCHAR), 3, '0') || 'A' AS codigo,
    'X' || CAST(NULLIF(c_custkey % 5, 0) AS VARCHAR) AS con_nulo FROM customer""")
def codes(s: Source):
    """Zero-padded codes (cut when longer) and concatenation, NULL when a part is."""
    key = F.col("c_custkey")
    return s.customer.select(
        key, F.concat(F.lit("CLI-"), text.fixed_pad(key, 3), F.lit("A")).alias("codigo"),
        F.concat(F.lit("X"), F.nullif(key % 5, F.lit(0)).cast("string")).alias("con_nulo"))


@query("f3_f5_text", """SELECT c_custkey, array_to_string(list_transform(string_split(upper(c_name) || ' DEL SUR', ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS nombre,
    lower(c_name) || '@example.com' AS email, c_mktsegment AS segmento FROM customer""")
def cleaned_text(s: Source):
    raw = s.customer.select(
        "c_custkey", F.concat(F.lit("  "), F.upper("c_name"), F.lit(" DEL SUR ")).alias("nombre"),
        F.concat(F.lit(" "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \n")).alias("segmento"))
    return raw.select("c_custkey", text.title_case("nombre").alias("nombre"), F.lower(F.trim("email")).alias("email"),
                      text.trim_all("segmento").alias("segmento"))


@query("f6_value_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'abierto' WHEN 'P' THEN 'pendiente' ELSE o_orderstatus END AS estado FROM orders")
def value_map(s: Source):
    return s.orders.select("o_orderkey", text.map_values("o_orderstatus", {"O": "abierto", "P": "pendiente"}).alias("estado"))


@query("f13_contains", "SELECT p_partkey, p_name LIKE '%ring%' AS anillo FROM part")
def contains(s: Source):
    return s.part.select("p_partkey", F.col("p_name").contains("ring").alias("anillo"))


@query("f14_round", """SELECT l_orderkey, l_linenumber, l_partkey, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.005, 2) AS DECIMAL(12,2)) AS dos,
    CAST(ROUND(-CAST(l_extendedprice AS DECIMAL(12,2)) * 0.00005, 4) AS DECIMAL(12,4)) AS cuatro FROM lineitem""")
def rounding(s: Source):
    """Halves go away from zero, on both sides of it."""
    gross = money("l_extendedprice")
    return s.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.rounded(gross * F.lit("0.005").cast("decimal(5,3)"), 2).alias("dos"),
        numbers.rounded(-gross * F.lit("0.00005").cast("decimal(6,5)"), 4).alias("cuatro"))


@query("f15_f18_arithmetic", f"""SELECT c_custkey, CAST(-{_SALDO} + 2 * {_SALDO} - 1 AS DECIMAL(18,2)) AS suma, (c_custkey - 700) % 7 AS resto,
    c_custkey // 12 AS cociente, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE
    {scaled('CAST((2 * (c_custkey + 1) * 1000000 + c_custkey % 4) // (2 * (c_custkey % 4)) AS HUGEINT)', 6, 'DECIMAL(18,6)')} END AS razon FROM customer""")
def arithmetic(s: Source):
    """Remainder with the sign of the dividend, integer division, null-safe division."""
    key, balance = F.col("c_custkey"), money("c_acctbal")
    ratio = numbers.safe_ratio(dec(key + 1, 18, 6), dec(key % 4, 10, 0))
    return s.customer.select(
        key, dec(-balance + 2 * balance - 1, 18, 2).alias("suma"), ((key - 700) % 7).alias("resto"),
        F.expr("c_custkey div 12").alias("cociente"), dec(F.round(ratio, 6), 18, 6).alias("razon"))


@query("f19_case_simple", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 ELSE 1 END AS peso FROM orders")
def case_simple(s: Source):
    weight = text.map_values("o_orderpriority", {"1-URGENT": 3, "2-HIGH": 2}, default=F.lit(1))
    return s.orders.select("o_orderkey", weight.alias("peso"))


@query("f20_banding", f"""SELECT c_custkey, CASE WHEN saldo IS NULL THEN 'Desconocida' WHEN saldo < 0 THEN 'Muy baja' WHEN saldo < 1000 THEN 'Baja'
    WHEN saldo < 5000 THEN 'Media' ELSE 'Alta' END AS banda FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN {_SALDO} END AS saldo FROM customer)""")
def banding(s: Source):
    balance = F.when(F.col("c_custkey") % 10 != 0, money("c_acctbal"))
    bands = [(0, "Muy baja"), (1000, "Baja"), (5000, "Media")]
    return s.customer.select("c_custkey", numbers.band(balance, bands, "Alta", "Desconocida").alias("banda"))


@query("f21_flags", "SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END > 1000, FALSE) AS solvente FROM customer")
def flags(s: Source):
    balance = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    return s.customer.select("c_custkey", numbers.flag(balance > 1000).alias("solvente"))


@query("f22_f24_dates", """SELECT o_orderkey, make_date(year(o_orderdate), 9, 1) AS inicio, CAST(CAST(o_orderdate AS DATE) + 365 AS DATE) AS caducidad,
    CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INT) AS DATE) AS entrega,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INT) AS dias FROM orders""")
def date_arithmetic(s: Source):
    day = F.to_date("o_orderdate")
    return s.orders.select(
        "o_orderkey", F.make_date(F.year(day), F.lit(9), F.lit(1)).alias("inicio"), dates.add_days(day, 365).alias("caducidad"),
        dates.add_days(day, F.col("o_orderkey") % 30).alias("entrega"),
        dates.days_between(F.lit("1995-01-01").cast("date"), day).alias("dias"))


@query("f25_date_parts", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, CAST(year(o_orderdate) AS INT) AS anio, CAST(quarter(o_orderdate) AS INT) AS trimestre,
    CAST(month(o_orderdate) AS INT) AS mes, CAST(day(o_orderdate) AS INT) AS dia, CAST(week(o_orderdate) AS INT) AS semana,
    CAST(isodow(o_orderdate) AS INT) AS dia_iso, CAST(dayofyear(o_orderdate) AS INT) AS dia_del_anio FROM orders""")
def date_parts(s: Source):
    parts = dates.calendar_parts("fecha")
    days = s.orders.select(F.to_date("o_orderdate").alias("fecha")).distinct()
    return days.select("fecha", *[parts[n].alias(n) for n in ("anio", "trimestre", "mes", "dia", "semana")],
                       dates.iso_weekday("fecha").alias("dia_iso"), F.dayofyear("fecha").alias("dia_del_anio"))


@query("f26_day_name", "SELECT o_orderkey, dayname(o_orderdate) AS nombre, rpad(dayname(o_orderdate), 9, ' ') AS relleno FROM orders")
def day_names(s: Source):
    return s.orders.select("o_orderkey", dates.day_name("o_orderdate").alias("nombre"),
                           dates.day_name("o_orderdate", padded=True).alias("relleno"))


@query("f27_casts", """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INT) AS cajas, CAST(l_partkey AS VARCHAR) AS texto,
    TRY_CAST(CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '' END || CAST(l_partkey AS VARCHAR) AS INT) AS numero FROM lineitem""")
def casts(s: Source):
    raw = F.concat(F.when(F.col("l_returnflag") == "R", "x").otherwise(""), F.col("l_partkey").cast("string"))
    return s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("cajas"),
                             F.col("l_partkey").cast("string").alias("texto"), raw.try_cast("int").alias("numero"))


@query("f28_percentages", f"""SELECT c_nationkey, total, objetivo, CASE WHEN objetivo <> 0 THEN
    {scaled('CAST(sign(total) * ((2 * abs(CAST(total * 100 AS HUGEINT)) * 1000000 + objetivo) // (2 * objetivo)) AS HUGEINT)', 6, 'DECIMAL(18,6)')} END AS pct
    FROM (SELECT c_nationkey, CAST(SUM({_SALDO}) AS DECIMAL(18,2)) AS total, CAST(c_nationkey % 5 * 10000 AS BIGINT) AS objetivo FROM customer GROUP BY c_nationkey)""")
def percentages(s: Source):
    """Divide, then multiply by a constant; no target gives no percentage."""
    totals = s.customer.groupBy("c_nationkey").agg(dec(F.sum(money("c_acctbal")), 18, 2).alias("total"))
    target = (F.col("c_nationkey") % 5 * 10000).cast("bigint")
    with_ratio = totals.withColumn("objetivo", target).withColumn(
        "razon", numbers.safe_ratio(dec("total", 28, 16), dec("objetivo", 15, 0)))
    return with_ratio.select("c_nationkey", "total", "objetivo", dec(F.round(F.col("razon") * 100, 6), 18, 6).alias("pct"))


@query("f29_number_masks", f"""SELECT c_custkey, regexp_replace(CAST({_SALDO} AS VARCHAR), '(\\.\\d)0$', '\\1') AS punto,
    replace(regexp_replace(CAST({_SALDO} AS VARCHAR), '(\\.\\d)0$', '\\1'), '.', ',') AS coma FROM customer""")
def number_masks(s: Source):
    return s.customer.select("c_custkey", numbers.number_text(money("c_acctbal"), 2).alias("punto"),
                             numbers.number_text(money("c_acctbal"), 2, symbol=",").alias("coma"))


@query("f30_weekend", "SELECT o_orderkey, isodow(o_orderdate) >= 6 AS es_festivo FROM orders")
def weekend(s: Source):
    return s.orders.select("o_orderkey", dates.is_weekend("o_orderdate").alias("es_festivo"))
