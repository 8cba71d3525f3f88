"""Upserts and conditional inserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import money
from ..operators.upsert import insert_if_absent, upsert
from .registry import Source, query

_TARGET = "SELECT c_custkey AS cliente_id, c_name AS nombre, c_mktsegment AS segmento, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo, CAST('base' AS VARCHAR) AS origen FROM customer WHERE c_acctbal >= 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"
# Every customer of two segments, each in two versions of which the later one counts.
_SOURCE = "SELECT c_custkey AS cliente_id, lower(c_name) AS nombre, c_mktsegment || '-2' AS segmento, CAST(c_acctbal AS DECIMAL(12,2)) + 200 AS saldo, 'carga' AS origen FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')"
_JOIN = f"FROM ({_TARGET}) t FULL JOIN ({_SOURCE}) s ON t.cliente_id = s.cliente_id"
_KEY = "COALESCE(t.cliente_id, s.cliente_id) AS cliente_id"


def _new(column: str) -> str:
    return f"CASE WHEN s.cliente_id IS NOT NULL THEN s.{column} ELSE t.{column} END AS {column}"


def _target(s: Source):
    """Customers in good standing, and those of segments the source does not hold: with the source, all of them."""
    return s.customer.filter("c_acctbal >= 0 or c_mktsegment not in ('BUILDING', 'MACHINERY')").select(
        F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("segmento"),
        money("c_acctbal").alias("saldo"), F.lit("base").alias("origen"))


def _source(s: Source):
    rows = s.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    versions = rows.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    return versions.select(
        F.col("c_custkey").alias("cliente_id"), F.lower("c_name").alias("nombre"),
        F.concat("c_mktsegment", F.lit("-"), F.col("version").cast("string")).alias("segmento"),
        money(money("c_acctbal") + F.col("version") * 100).alias("saldo"), F.lit("carga").alias("origen"), "version")


_UPSERTED = f"SELECT {_KEY}, {_new('nombre')}, {_new('segmento')}, CAST({_new('saldo').removesuffix(' AS saldo')} AS DECIMAL(12,2)) AS saldo, {_new('origen')} {_JOIN}"


@query("u1_upsert", _UPSERTED)
def upserted(s: Source):
    return upsert(_target(s), _source(s), ["cliente_id"], order_by=["version"])


@query("u1_upsert_twice", _UPSERTED)
def upserted_twice(s: Source):
    once = upsert(_target(s), _source(s), ["cliente_id"], order_by=["version"])
    return upsert(once, _source(s), ["cliente_id"], order_by=["version"])


@query("u1_two_keys", """SELECT COALESCE(t.suppkey, s.suppkey) AS suppkey, COALESCE(t.flag, s.flag) AS flag, COALESCE(s.lineas, t.lineas) AS lineas FROM
    (SELECT l_suppkey AS suppkey, l_returnflag AS flag, COUNT(*) AS lineas FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' GROUP BY 1, 2) t FULL JOIN
    (SELECT l_suppkey AS suppkey, l_returnflag AS flag, -COUNT(*) AS lineas FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2) s
    ON t.suppkey = s.suppkey AND t.flag = s.flag""")
def upserted_by_two_keys(s: Source):
    def counted(rows, sign):
        return rows.groupBy(F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("flag")).agg(
            (F.count(F.lit(1)) * sign).alias("lineas"))

    old = counted(s.lineitem.filter("l_shipdate < '1999-01-01'"), 1)
    new = counted(s.lineitem.filter("l_shipdate >= '1999-01-01'"), -1)
    return upsert(old, new, ["suppkey", "flag"])


@query("u1_surrogate_keys", f"""WITH base AS (SELECT CAST(row_number() OVER (ORDER BY cliente_id) AS BIGINT) AS sk, * FROM ({_TARGET})),
    merged AS (SELECT sk, {_KEY}, {_new('nombre')} FROM base t FULL JOIN ({_SOURCE}) s ON t.cliente_id = s.cliente_id)
    SELECT sk, cliente_id, nombre FROM merged WHERE sk IS NOT NULL UNION ALL
    SELECT CAST((SELECT MAX(sk) FROM base) + row_number() OVER (ORDER BY cliente_id) AS BIGINT), cliente_id, nombre FROM merged WHERE sk IS NULL""")
def upserted_dimension(s: Source):
    """Existing keys survive the load, new members are numbered after them."""
    from ..operators.keys import assign_sk

    dim = assign_sk(_target(s).select("cliente_id", "nombre"), "sk", ["cliente_id"])
    source = _source(s).filter("version = 2").select("cliente_id", "nombre")
    return upsert(dim, source, ["cliente_id"], sk="sk")


@query("u2_update_flags", f"""SELECT {_KEY}, CASE WHEN t.cliente_id IS NOT NULL THEN t.nombre ELSE s.nombre END AS nombre, {_new('segmento')},
    CASE WHEN t.cliente_id IS NOT NULL THEN t.saldo ELSE CAST(s.saldo AS DECIMAL(12,2)) END AS saldo, {_new('origen')} {_JOIN}""")
def update_flags(s: Source):
    """Name and balance are set on insert only."""
    return upsert(_target(s), _source(s), ["cliente_id"], update_cols=["segmento", "origen"],
                  insert_only_cols=["nombre", "saldo"], order_by=["version"])


@query("u5_partial_columns", f"SELECT {_KEY}, t.nombre, {_new('segmento')}, t.saldo, t.origen {_JOIN}")
def partial_columns(s: Source):
    """Only the segment is carried; an inserted row has no other attribute."""
    return upsert(_target(s), _source(s), ["cliente_id"], update_cols=["segmento"], order_by=["version"])


@query("u3_insert_if_absent", f"""SELECT * FROM ({_TARGET}) UNION ALL
    SELECT c_custkey, lower(c_name), c_mktsegment || '-1', CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 100 AS DECIMAL(12,2)), 'carga' FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal < 0""")
def inserted_if_absent(s: Source):
    """The first version of an absent customer is inserted, everything else stays."""
    return insert_if_absent(_target(s), _source(s), ["cliente_id"], ["version"])


@query("u4_insert_new_dates", """SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, o_orderdate < TIMESTAMP '1998-01-01' AS antigua FROM orders""")
def inserted_dates(s: Source):
    """Insert that ignores dates already there."""
    days = s.orders.select(F.to_date("o_orderdate").alias("fecha")).distinct()
    known = days.filter("fecha < '1998-01-01'").withColumn("antigua", F.lit(True))
    return insert_if_absent(known, days.withColumn("antigua", F.lit(False)), ["fecha"])
