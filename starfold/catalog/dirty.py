"""Defective inputs derived from the given tables, with the same inputs in SQL.

Every row is kept; identifiers decide which defect a row gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import dec
from ..functions.text import cycle
from .registry import Source
from .sql import pick

_CITIES = [" sevila ", "MALAGA", "malaga", "Almería", "Granada", "grañada", "madri", "Barcelona", "alacant", " Bilbao", "Oviedo"]
_CONDITIONS = ["Soleado", " Soleado ", "Granizo", "", "Lluvia", "Niebla", "  "]

OBSERVATIONS_SQL = f"""SELECT id AS observacion_id, fecha, CASE WHEN id % 41 = 0 THEN NULL ELSE {pick(_CITIES, 'id')} END AS ciudad,
    CASE WHEN id % 37 = 0 THEN NULL ELSE user_id END AS estacion_id,
    CAST(CASE WHEN id % 17 = 0 THEN NULL WHEN id % 13 = 0 THEN -99 ELSE (cents % 450) * 0.1 - 5 END AS DECIMAL(5,1)) AS temp_max,
    CAST(CASE WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN -99 ELSE ((cents * 7) % 300) * 0.1 - 8 END AS DECIMAL(5,1)) AS temp_min,
    CAST(CASE WHEN id % 23 = 0 THEN NULL WHEN id % 29 = 0 THEN -99 ELSE ((cents * 3) % 350) * 0.1 - 6 END AS DECIMAL(5,1)) AS temp_media,
    CAST(CASE WHEN id % 34 = 0 THEN NULL WHEN id % 7 = 0 THEN -3 WHEN id % 31 = 0 THEN -99 ELSE (cents % 50) * 0.1 END AS DECIMAL(6,1)) AS precipitacion_mm,
    CAST(CASE WHEN id % 43 = 0 THEN NULL ELSE cents % 121 - 10 END AS INT) AS humedad_pct,
    CAST((cents % 900) * 0.1 AS DECIMAL(5,1)) AS velocidad_viento_kmh,
    CASE WHEN id % 47 = 0 THEN NULL ELSE {pick(_CONDITIONS, 'id')} END AS condicion_climatica
    FROM (SELECT event_id AS id, user_id, CAST(ts AS DATE) AS fecha, CAST(CAST(value AS DECIMAL(10,2)) * 100 AS BIGINT) AS cents FROM events)"""

STATIONS_SQL = "SELECT s_suppkey AS estacion_id, s_name AS nombre_estacion FROM supplier"


def observations(s: Source) -> DataFrame:
    """Weather readings from events: the value gives the numbers, the user the station."""
    ident = F.col("observacion_id")
    base = s.events.select(
        F.col("event_id").alias("observacion_id"), "user_id", F.to_date("ts").alias("fecha"),
        (dec("value", 10, 2) * 100).cast("bigint").alias("cents"))
    tenth = F.lit("0.1").cast("decimal(2,1)")

    def reading(cases, value, precision=5):
        result = F.when(F.lit(False), F.lit(None).cast(f"decimal({precision},1)"))
        for divisor, defect in cases:
            result = result.when(ident % divisor == 0, F.lit(defect).cast(f"decimal({precision},1)"))
        return result.otherwise(value.cast(f"decimal({precision},1)"))

    cents = F.col("cents")
    return base.select(
        "observacion_id", "fecha",
        F.when(ident % 41 != 0, cycle(_CITIES, ident)).alias("ciudad"),
        F.when(ident % 37 != 0, F.col("user_id")).alias("estacion_id"),
        reading([(17, None), (13, -99)], cents % 450 * tenth - 5).alias("temp_max"),
        reading([(17, None), (19, -99)], cents * 7 % 300 * tenth - 8).alias("temp_min"),
        reading([(23, None), (29, -99)], cents * 3 % 350 * tenth - 6).alias("temp_media"),
        reading([(34, None), (7, -3), (31, -99)], cents % 50 * tenth, 6).alias("precipitacion_mm"),
        F.when(ident % 43 != 0, (cents % 121 - 10).cast("int")).alias("humedad_pct"),
        (cents % 900 * tenth).cast("decimal(5,1)").alias("velocidad_viento_kmh"),
        F.when(ident % 47 != 0, cycle(_CONDITIONS, ident)).alias("condicion_climatica"))


def stations(s: Source) -> DataFrame:
    return s.supplier.select(F.col("s_suppkey").alias("estacion_id"), F.col("s_name").alias("nombre_estacion"))


CUSTOMERS_SQL = f"""SELECT c_custkey AS cliente_id, CASE WHEN c_custkey % 5 = 0 THEN '  ' || upper(c_name) || ' HIJOS ' ELSE c_name || ' hijos' END AS nombre_cliente,
    {pick(['mayorista', 'distribuidor', 'minorista', 'retail', 'otro'], 'c_custkey')} AS tipo_cliente, 'directo' AS canal, c_mktsegment AS segmento,
    n_name AS pais, n_name || '-' || CAST(c_custkey % 4 AS VARCHAR) AS ciudad,
    CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 12 = 5 THEN 'Cliente' || CAST(c_custkey AS VARCHAR) || '.example.com'
      ELSE ' Cliente' || CAST(c_custkey AS VARCHAR) || '@Example.com ' END AS email, CAST(c_custkey AS VARCHAR) AS telefono
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def customers(s: Source) -> DataFrame:
    """Customers with missing or malformed e-mails and shouting names."""
    key = F.col("c_custkey")
    joined = s.customer.join(s.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        key.alias("cliente_id"),
        F.when(key % 5 == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" HIJOS ")))
        .otherwise(F.concat("c_name", F.lit(" hijos"))).alias("nombre_cliente"),
        cycle(["mayorista", "distribuidor", "minorista", "retail", "otro"], key).alias("tipo_cliente"),
        F.lit("directo").alias("canal"), F.col("c_mktsegment").alias("segmento"), F.col("n_name").alias("pais"),
        F.concat("n_name", F.lit("-"), (key % 4).cast("string")).alias("ciudad"),
        F.when(key % 8 == 0, F.lit(None))
        .when(key % 12 == 5, F.concat(F.lit("Cliente"), key.cast("string"), F.lit(".example.com")))
        .otherwise(F.concat(F.lit(" Cliente"), key.cast("string"), F.lit("@Example.com "))).alias("email"),
        key.cast("string").alias("telefono"))
