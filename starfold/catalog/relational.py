"""Projections, filters, joins, aggregates, windows and sorts over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import dec, money, safe_ratio
from ..operators.dedup import keep_first, top1_per_group
from ..operators.joins import hot_keys, salted_join
from ..operators.lookup import lookup, orphans
from ..operators.reshape import add_constant, expand_list, retype, select_values, unpivot_exprs
from ..operators.route import route, tagged
from .registry import Source, query
from .sql import half_up_int, mean6

_GROSS = "CAST(l_extendedprice AS DECIMAL(12,2))"
_RATE = "CAST(l_discount AS DECIMAL(5,2))"


@query("p1_select_values", "SELECT c_name AS nombrecliente, c_custkey AS clienteid FROM customer")
def projection(s: Source):
    return select_values(s.customer, {"c_name": "nombrecliente", "c_custkey": "clienteid"})


@query("p2_retype", "SELECT event_id, CAST(value AS DECIMAL(5,1)) AS value FROM events")
def retyping(s: Source):
    exact = s.events.select("event_id", dec("value", 10, 2).alias("value"))
    return retype(exact, {"value": T.DecimalType(5, 1)})


@query("p3_computed_projection", f"SELECT l_orderkey, l_linenumber, {_GROSS} AS bruto, CAST({_GROSS} * {_RATE} AS DECIMAL(18,4)) AS descuento FROM lineitem")
def computed(s: Source):
    gross = money("l_extendedprice")
    return s.lineitem.select("l_orderkey", "l_linenumber", gross.alias("bruto"),
                             dec(gross * dec("l_discount", 5, 2), 18, 4).alias("descuento"))


@query("p4_constant", "SELECT o_orderkey, CAST(100 AS INT) AS cien FROM orders")
def constant(s: Source):
    return add_constant(s.orders.select("o_orderkey"), "cien", 100, "int")


@query("p5_modulo_filter", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 5 = 0")
def every_fifth(s: Source):
    """The feature is the predicate itself: incidents fall on every fifth row."""
    return s.orders.filter(F.col("o_orderkey") % 5 == 0).select("o_orderkey", "o_orderstatus")


@query("p6_between_slice", "SELECT COUNT(*) AS lineas, MIN(l_orderkey) AS primera, MAX(l_orderkey) AS ultima FROM lineitem "
       "WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'")
def slice_of_lines(s: Source):
    lines = s.lineitem.filter(F.col("l_shipdate").between("1998-01-01", "1998-12-31"))
    return lines.agg(F.count(F.lit(1)).alias("lineas"), F.min("l_orderkey").alias("primera"), F.max("l_orderkey").alias("ultima"))


@query("p7_window_filter", """SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def largest_order(s: Source):
    top = top1_per_group(s.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return top.select("o_custkey", "o_orderkey", money("o_totalprice").alias("total"))


@query("p12_in_lists", """SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgente,
    o_orderstatus NOT IN ('F') AS abierto, o_totalprice BETWEEN 1000 AND 100000 AS normal FROM orders""")
def lists(s: Source):
    return s.orders.select(
        "o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgente"),
        (~F.col("o_orderstatus").isin("F")).alias("abierto"), F.col("o_totalprice").between(1000, 100000).alias("normal"))


_OK = "l_shipdate >= o_orderdate"
_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _dated_lines(s: Source):
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = s.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return lines.join(orders, "l_orderkey")


@query("p11_route_ok", f"SELECT l_orderkey, l_linenumber, l_partkey {_LINES} WHERE {_OK}")
def routed_ok(s: Source):
    ok, _ = route(_dated_lines(s), F.col("l_shipdate") >= F.col("o_orderdate"))
    return ok.select("l_orderkey", "l_linenumber", "l_partkey")


@query("p11_route_rejected", f"SELECT l_orderkey, l_linenumber, l_partkey {_LINES} WHERE NOT COALESCE({_OK}, FALSE)")
def routed_rejected(s: Source):
    _, rejected = route(_dated_lines(s), F.col("l_shipdate") >= F.col("o_orderdate"))
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey")


@query("p11_route_counts", f"SELECT COALESCE({_OK}, FALSE) AS ok, COUNT(*) AS filas {_LINES} GROUP BY 1")
def routed_counts(s: Source):
    lines = tagged(_dated_lines(s), F.col("l_shipdate") >= F.col("o_orderdate"))
    return lines.groupBy("ok").agg(F.count(F.lit(1)).alias("filas"))


@query("j1_equi_join", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def equi_join(s: Source):
    return s.orders.join(s.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@query("j5_composite_join", """SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, COUNT(*) AS copias FROM lineitem a
    JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
    GROUP BY a.l_orderkey, a.l_linenumber, a.l_partkey""")
def composite_join(s: Source):
    """Lines next to the number of lines sharing order and line number.

    The partner side is reduced to a count per composite key first: equal keys
    are never paired with each other.
    """
    keys = ["l_orderkey", "l_linenumber"]
    lines = s.lineitem.select(*keys, "l_partkey")
    per_part = lines.groupBy(*keys, "l_partkey").agg(F.count(F.lit(1)).alias("propias"))
    per_key = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("todas"))
    return per_part.join(per_key, keys).select(*keys, "l_partkey", (F.col("propias") * F.col("todas")).alias("copias"))


@query("j7_computed_key", """SELECT o_orderkey, s_name FROM orders JOIN supplier
    ON s_suppkey = o_orderkey % (SELECT COUNT(*) FROM supplier)""")
def computed_key(s: Source):
    """The key expression is a column before the join, so that it is an equi-join."""
    suppliers = s.supplier.agg(F.count(F.lit(1))).scalar()
    orders = s.orders.select("o_orderkey", (F.col("o_orderkey") % suppliers).alias("s_suppkey"))
    return orders.join(s.supplier, "s_suppkey").select("o_orderkey", "s_name")


_RICH = "(SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000)"


@query("j8_lookup_default", f"SELECT o_orderkey, CAST(COALESCE(c_acctbal, 0) AS DECIMAL(12,2)) AS saldo FROM orders LEFT JOIN {_RICH} ON o_custkey = c_custkey")
def lookup_default(s: Source):
    rich = s.customer.filter("c_acctbal > 5000").select("c_custkey", money("c_acctbal").alias("c_acctbal"))
    found = lookup(s.orders.select("o_orderkey", "o_custkey"), rich, {"o_custkey": "c_custkey"}, {"c_acctbal": ("saldo", 0)})
    return found.select("o_orderkey", money("saldo").alias("saldo"))


@query("j9_lookup_first", """SELECT p_partkey, COALESCE(l_suppkey, -1) AS primer_proveedor FROM part LEFT JOIN (
    SELECT l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_suppkey, l_orderkey) AS rn
    FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1) ON p_partkey = l_partkey""")
def lookup_first(s: Source):
    """A reference with several matches per key: the first one counts, none gives -1."""
    returns = s.lineitem.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey")
    return lookup(s.part.select("p_partkey"), returns, {"p_partkey": "l_partkey"}, {"l_suppkey": ("primer_proveedor", -1)},
                  first_by=["l_shipdate", "l_suppkey", "l_orderkey"])


@query("j10_orphans", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 3000)")
def orphan_lines(s: Source):
    lines = s.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    return orphans(lines, s.supplier.filter("s_acctbal >= 3000"), {"l_suppkey": "s_suppkey"})


@query("j11_cross_list", "SELECT p_partkey, t AS talla FROM part, (SELECT unnest(['S', 'M', 'L', 'XL']) AS t)")
def cross_list(s: Source):
    return expand_list(s.part.select("p_partkey"), "talla", ["S", "M", "L", "XL"])


@query("j12_unpivot", f"""SELECT l_orderkey, l_linenumber, l_partkey, 'bruto' AS concepto, CAST({_GROSS} AS DECIMAL(18,4)) AS importe FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'descuento', CAST(-{_GROSS} * {_RATE} AS DECIMAL(18,4)) FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'impuesto', CAST({_GROSS} * CAST(l_tax AS DECIMAL(5,2)) AS DECIMAL(18,4)) FROM lineitem""")
def unpivot(s: Source):
    gross = money("l_extendedprice")
    cases = [("bruto", dec(gross, 18, 4)), ("descuento", dec(-gross * dec("l_discount", 5, 2), 18, 4)),
             ("impuesto", dec(gross * dec("l_tax", 5, 2), 18, 4))]
    return unpivot_exprs(s.lineitem, cases, "concepto", "importe", keep=["l_orderkey", "l_linenumber", "l_partkey"])


@query("j1_salted_join", "SELECT l_returnflag, c_nationkey, COUNT(*) AS lineas, SUM(CAST(l_quantity AS DECIMAL(10,2))) AS kilos FROM lineitem "
       "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2")
def salted(s: Source):
    """Lines joined to a side by a key few values of which hold most rows, spread by salt."""
    lines = s.lineitem.select("l_orderkey", "l_returnflag", dec("l_quantity", 10, 2).alias("kilos"))
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    nations = s.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    hot = hot_keys(orders, ["o_custkey"], share=0.0005)
    keyed = salted_join(orders, nations, ["o_custkey"], hot, salts=4)
    joined = salted_join(lines, keyed, ["l_orderkey"], [], "inner")
    return joined.groupBy("l_returnflag", "c_nationkey").agg(
        F.count(F.lit(1)).alias("lineas"), F.sum("kilos").cast("decimal(38,2)").alias("kilos"))


@query("g1_group_sums", f"""SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS kilos,
    CAST(SUM({_GROSS}) AS DECIMAL(18,2)) AS bruto FROM lineitem GROUP BY 1, 2""")
def group_sums(s: Source):
    return s.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        dec(F.sum(dec("l_quantity", 10, 2)), 18, 2).alias("kilos"), dec(F.sum(money("l_extendedprice")), 18, 2).alias("bruto"))


@query("g2_sum_of_expression", f"SELECT l_suppkey, CAST(SUM({_GROSS} - {_GROSS} * {_RATE}) AS DECIMAL(18,4)) AS neto FROM lineitem GROUP BY 1")
def sum_of_expression(s: Source):
    gross = money("l_extendedprice")
    return s.lineitem.groupBy("l_suppkey").agg(dec(F.sum(gross - gross * dec("l_discount", 5, 2)), 18, 4).alias("neto"))


@query("g3_average", f"SELECT l_suppkey, {mean6('CAST(l_extendedprice * 100 + 0.01 AS HUGEINT)', 2)} AS bruto_medio FROM lineitem GROUP BY 1")
def average(s: Source):
    """A mean from an exact sum and a count, so that it does not depend on row order."""
    gross = money("l_extendedprice")
    return s.lineitem.groupBy("l_suppkey").agg(dec(F.round(F.sum(gross) / F.count(gross), 6), 18, 6).alias("bruto_medio"))


@query("g4_average_ratio", f"SELECT l_suppkey, {mean6(half_up_int(_GROSS, 'NULLIF(CAST(l_quantity AS DECIMAL(10,2)) - 1, 0)', 13), 13)} AS precio_medio FROM lineitem GROUP BY 1")
def average_ratio(s: Source):
    """Unweighted mean of row ratios; a zero denominator gives NULL and is left out."""
    ratio = safe_ratio(money("l_extendedprice"), dec(F.col("l_quantity") - 1, 10, 2))
    return s.lineitem.groupBy("l_suppkey").agg(dec(F.round(F.sum(ratio) / F.count(ratio), 6), 18, 6).alias("precio_medio"))


@query("g5_average_days", f"SELECT l_suppkey, {mean6('date_diff(chr(39) || chr(39), o_orderdate, l_shipdate)', 0)} AS dias FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"
       .replace("chr(39) || chr(39)", "'day'"))
def average_days(s: Source):
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = s.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate").join(orders, "l_orderkey")
    days = dec(F.datediff("l_shipdate", "o_orderdate"), 10, 0)
    return lines.groupBy("l_suppkey").agg(dec(F.round(F.sum(days) / F.count(days), 6), 18, 6).alias("dias"))


@query("g6_group_by_expression", """SELECT CAST(year(o_orderdate) AS INT) AS anio, CASE WHEN o_totalprice >= 250000 THEN 'Primera' ELSE 'Segunda' END AS categoria,
    COUNT(*) AS pedidos FROM orders GROUP BY 1, 2""")
def group_by_expression(s: Source):
    category = F.when(F.col("o_totalprice") >= 250000, "Primera").otherwise("Segunda")
    return s.orders.groupBy(F.year("o_orderdate").alias("anio"), category.alias("categoria")).agg(F.count(F.lit(1)).alias("pedidos"))


@query("g7_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct(s: Source):
    return s.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("g8_dedup_keep_first", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(10,2)) AS kilos FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS rn
    FROM lineitem) WHERE rn = 1""")
def dedup(s: Source):
    first = keep_first(s.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dec("l_quantity", 10, 2).alias("kilos"))


@query("w1_top1_per_group", """SELECT l_partkey, l_returnflag, kilos FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY kilos DESC, l_returnflag) AS rn
    FROM (SELECT l_partkey, l_returnflag, CAST(SUM(CAST(l_quantity AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS kilos FROM lineitem GROUP BY 1, 2)) WHERE rn = 1""")
def dominant_flag(s: Source):
    """Dominant category per part by summed quantity; a tie goes to the first in the alphabet."""
    kilos = s.lineitem.groupBy("l_partkey", "l_returnflag").agg(dec(F.sum(dec("l_quantity", 10, 2)), 18, 2).alias("kilos"))
    return top1_per_group(kilos, ["l_partkey"], [F.desc("kilos"), F.asc("l_returnflag")])


@query("o1_sort_descending", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders ORDER BY total DESC, o_orderkey")
def sort_descending(s: Source):
    """Report order. The key breaks ties, so equal totals are still split between sort partitions."""
    orders = s.orders.select("o_orderkey", money("o_totalprice").alias("total"))
    return orders.orderBy(F.desc("total"), F.asc("o_orderkey"))


@query("o2_sort_multi_key", "SELECT l_shipdate, l_partkey, l_orderkey FROM lineitem ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_orderkey")
def sort_multi_key(s: Source):
    lines = s.lineitem.select("l_shipdate", "l_partkey", "l_orderkey")
    return lines.orderBy(F.asc_nulls_first("l_shipdate"), F.asc_nulls_first("l_partkey"), "l_orderkey")
