"""Data-quality rules: violations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import dec, money, rounded
from ..operators.quality import (
    ForeignKey, Unique, apply_defaults, check, duplicate_keys, in_domain, in_range, max_length, missing_parents,
    not_before, not_null, row_violations, validate,
)
from ..schemas import OLTP, SNOW, STAR, layer_reports, payments_before_invoice
from ..session import collected
from .dirty import CUSTOMERS_SQL, OBSERVATIONS_SQL, customers, observations
from .registry import Source, query


def _report(rule: str, key: str, value: str, rest: str) -> str:
    return f"SELECT '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, CAST({value} AS VARCHAR) AS value {rest}"


_OBS = f"FROM ({OBSERVATIONS_SQL})"


@query("q1_not_null", " UNION ALL ".join(
    _report(f"not_null:{c}", "observacion_id", "NULL", f"{_OBS} WHERE {c} IS NULL") for c in ("ciudad", "estacion_id", "temp_max")))
def nulls(s: Source):
    return row_violations(observations(s), ["observacion_id"], [not_null(c) for c in ("ciudad", "estacion_id", "temp_max")])


@query("q2_unique", "SELECT 'unique:l_orderkey,l_linenumber' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, "
       "CAST(COUNT(*) AS VARCHAR) AS value FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def uniqueness(s: Source):
    return duplicate_keys(s.lineitem, ["l_orderkey", "l_linenumber"])


@query("q3_foreign_key", _report("foreign_key:o_custkey", "o_orderkey", "o_custkey",
       "FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"))
def references(s: Source):
    solvent = s.customer.filter("c_acctbal >= 0")
    return missing_parents(s.orders, ["o_orderkey"], ForeignKey(["o_custkey"], solvent, ["c_custkey"]))


@query("q4_range", " UNION ALL ".join([
    _report("range:humedad_pct", "observacion_id", "humedad_pct", f"{_OBS} WHERE NOT COALESCE(humedad_pct BETWEEN 0 AND 100, TRUE)"),
    _report("range:precipitacion_mm", "observacion_id", "precipitacion_mm", f"{_OBS} WHERE precipitacion_mm < 0"),
    _report("range:velocidad_viento_kmh", "observacion_id", "velocidad_viento_kmh", f"{_OBS} WHERE velocidad_viento_kmh <= 0")]))
def ranges(s: Source):
    rules = [in_range("humedad_pct", 0, 100), in_range("precipitacion_mm", 0), in_range("velocidad_viento_kmh", 0, open_low=True)]
    return row_violations(observations(s), ["observacion_id"], rules)


@query("q5_domain", _report("domain:tipo_cliente", "cliente_id", "tipo_cliente",
       f"FROM ({CUSTOMERS_SQL}) WHERE tipo_cliente NOT IN ('mayorista', 'distribuidor', 'minorista', 'retail')"))
def domains(s: Source):
    return row_violations(customers(s), ["cliente_id"], [in_domain("tipo_cliente", ("mayorista", "distribuidor", "minorista", "retail"))])


@query("q6_date_order", "SELECT 'order:o_orderdate<=l_shipdate' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, "
       "strftime(l_shipdate, '%Y-%m-%d') AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)")
def date_order(s: Source):
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("o_orderdate"))
    lines = s.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate")).join(orders, "l_orderkey")
    return row_violations(lines, ["l_orderkey", "l_linenumber"], [not_before("l_shipdate", "o_orderdate")])


@query("q7_arithmetic", "SELECT 'check:bruto' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, "
       "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS value FROM lineitem JOIN part ON l_partkey = p_partkey "
       "WHERE CAST(l_extendedprice AS DECIMAL(12,2)) <> ROUND(CAST(l_quantity AS DECIMAL(10,2)) * CAST(p_retailprice AS DECIMAL(12,2)), 2)")
def arithmetic(s: Source):
    """Gross amount against quantity times list price."""
    prices = s.part.select(F.col("p_partkey").alias("l_partkey"), money("p_retailprice").alias("precio"))
    lines = s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", dec("l_quantity", 10, 2).alias("kilos"),
                              money("l_extendedprice").alias("bruto")).join(prices, "l_partkey")
    expected = rounded(F.col("kilos") * F.col("precio"), 2, 18)
    return row_violations(lines, ["l_orderkey", "l_linenumber"], [check("bruto", F.col("bruto") == expected, F.col("bruto"))])


@query("q8_cross_table_dates", _report("order:fecha_emision<=fecha_cobro", "l_orderkey", "strftime(fecha_cobro, '%Y-%m-%d')", """FROM
    (SELECT l_orderkey, MIN(l_shipdate) AS fecha_cobro FROM lineitem GROUP BY l_orderkey) JOIN orders ON l_orderkey = o_orderkey
    WHERE CAST(fecha_cobro AS DATE) < CAST(o_orderdate AS DATE)"""))
def payment_dates(s: Source):
    """Payments dated before their invoice: here first shipment against order."""
    payments = s.lineitem.groupBy(F.col("l_orderkey").alias("cobro_id")).agg(F.to_date(F.min("l_shipdate")).alias("fecha_cobro"))
    invoices = s.orders.select(F.col("o_orderkey").alias("factura_id"), F.to_date("o_orderdate").alias("fecha_emision"))
    return payments_before_invoice(payments.withColumn("factura_id", F.col("cobro_id")), invoices)


@query("q9_length", _report("length:p_name", "p_partkey", "p_name", "FROM part WHERE length(p_name) > 10"))
def lengths(s: Source):
    return row_violations(s.part, ["p_partkey"], [max_length("p_name", 10)])


@query("q10_defaults", f"SELECT observacion_id, COALESCE(humedad_pct, 50) AS humedad_pct, COALESCE(ciudad, 'Sin ciudad') AS ciudad {_OBS}")
def defaults(s: Source):
    filled = apply_defaults(observations(s), {"humedad_pct": 50, "ciudad": "Sin ciudad"})
    return filled.select("observacion_id", "humedad_pct", "ciudad")


@query("q_layer_violations", """SELECT 'oltp' AS capa, 'clientes' AS tabla, 'domain:segmento' AS rule, CAST(c_custkey + 1 AS VARCHAR) AS key,
    lower(c_mktsegment) AS value FROM customer WHERE lower(c_mktsegment) NOT IN ('premium', 'estandar', 'ocasional')
    UNION ALL SELECT 'oltp', 'detalle_pedido', 'unique:detalle_id', CAST((l_orderkey + 1) * 100 + l_linenumber AS VARCHAR), CAST(COUNT(*) AS VARCHAR)
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def layer_violations(s: Source):
    """Every declared rule over every table of the OLTP layer and of both models.

    The segments of the given customers are not those of the model, and some given lines share order and number:
    each is a violation, and there are no others.
    """
    w = s.warehouse
    layers = {"oltp": (w.oltp, OLTP), "star": (w.star, STAR), "snow": (w.snow, SNOW)}
    reports = (report.select(F.lit(layer).alias("capa"), "tabla", "rule", "key", "value") for layer, (tables, declared) in layers.items()
               for report in layer_reports({n: w.served(tables, n) for n in declared}, declared))
    return collected(s.spark, reports, "violations")


@query("q_validate", " UNION ALL ".join([
    _report("not_null:ciudad", "observacion_id", "NULL", f"{_OBS} WHERE ciudad IS NULL"),
    _report("range:humedad_pct", "observacion_id", "humedad_pct", f"{_OBS} WHERE NOT COALESCE(humedad_pct BETWEEN 0 AND 100, TRUE)"),
    _report("foreign_key:estacion_id", "observacion_id", "estacion_id", f"{_OBS} WHERE estacion_id NOT IN (SELECT s_suppkey FROM supplier)")]))
def validation(s: Source):
    """Row, unique and foreign-key rules of one table in one report."""
    stations = s.supplier.select(F.col("s_suppkey").alias("estacion_id"))
    return validate(observations(s), ["observacion_id"], [
        not_null("ciudad"), in_range("humedad_pct", 0, 100), Unique(["observacion_id"]), ForeignKey(["estacion_id"], stations)])
