"""Cleaning rules and the weather and customer pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import negative_to_zero, ordered_pair, outside_to_null, sentinel_to_null
from ..functions.text import canonical, in_vocabulary
from ..operators.reshape import select_values

from ..plans import customers as customer_plans
from ..plans import weather
from ..session import written
from .dirty import CUSTOMERS_SQL, OBSERVATIONS_SQL, STATIONS_SQL, customers, observations, stations
from .registry import Source, query
from .sql import quoted

_CITY = "CASE " + " ".join(
    f"WHEN lower(trim(ciudad)) IN ({quoted(v)}) THEN '{name}'" for name, v in weather.CITY_SPELLINGS.items()) + " ELSE ciudad END"
_CONDITION = f"CASE WHEN trim(condicion_climatica) IN ({quoted(weather.CONDITIONS)}) THEN condicion_climatica ELSE 'Desconocido' END"


def _no_error(column: str) -> str:
    return f"NULLIF({column}, -99)"


_MAX, _MIN = _no_error("temp_max"), _no_error("temp_min")
_CLEAN = f"""SELECT observacion_id, fecha, {_CITY} AS ciudad, estacion_id,
    CASE WHEN {_MIN} > {_MAX} THEN {_MIN} ELSE {_MAX} END AS temp_max, CASE WHEN {_MIN} > {_MAX} THEN {_MAX} ELSE {_MIN} END AS temp_min,
    {_no_error('temp_media')} AS temp_media, CAST(CASE WHEN precipitacion_mm < 0 THEN 0 ELSE precipitacion_mm END AS DECIMAL(6,1)) AS precipitacion_mm,
    CASE WHEN humedad_pct BETWEEN 0 AND 100 THEN humedad_pct END AS humedad_pct, velocidad_viento_kmh, {_CONDITION} AS condicion_climatica FROM obs"""
_STAGES = f"""WITH obs AS ({OBSERVATIONS_SQL}), est AS ({STATIONS_SQL}), limpio AS ({_CLEAN}),
    con_dato AS (SELECT * FROM limpio WHERE temp_max IS NOT NULL OR temp_min IS NOT NULL OR precipitacion_mm IS NOT NULL),
    conocido AS (SELECT * FROM con_dato WHERE estacion_id IN (SELECT estacion_id FROM est)),
    unico AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY fecha, ciudad ORDER BY observacion_id) AS rn FROM conocido) WHERE rn = 1)
    """


def _classified(s: Source):
    return weather.classify(observations(s), stations(s))


@query("p8_email_valid", f"SELECT cliente_id, email IS NOT NULL AND email LIKE '%@%' AS valido FROM ({CUSTOMERS_SQL})")
def email_valid(s: Source):
    email = F.col("email")
    return customers(s).select("cliente_id", (email.isNotNull() & email.contains("@")).alias("valido"))


@query("p9_any_reading", f"SELECT observacion_id FROM ({OBSERVATIONS_SQL}) WHERE temp_max IS NOT NULL OR temp_min IS NOT NULL OR precipitacion_mm IS NOT NULL")
def any_reading(s: Source):
    return observations(s).filter(weather.has_reading()).select("observacion_id")


@query("p10_lookup_flag", f"SELECT observacion_id, CASE WHEN estacion_id IN (SELECT estacion_id FROM ({STATIONS_SQL})) THEN estacion_id ELSE -1 END AS lkp_estacion FROM ({OBSERVATIONS_SQL})")
def lookup_flag(s: Source):
    from ..operators.lookup import lookup

    found = lookup(observations(s), stations(s), {"estacion_id": "estacion_id"}, {"estacion_id": ("lkp_estacion", -1)},
                   first_by=["nombre_estacion"])
    return found.select("observacion_id", "lkp_estacion")


@query("f7_canonicalise", f"SELECT observacion_id, {_CITY} AS ciudad FROM ({OBSERVATIONS_SQL})")
def canonical_cities(s: Source):
    return observations(s).select("observacion_id", canonical("ciudad", weather.CITY_SPELLINGS).alias("ciudad"))


@query("f8_vocabulary", f"SELECT observacion_id, {_CONDITION} AS condicion_climatica FROM ({OBSERVATIONS_SQL})")
def vocabulary(s: Source):
    checked = in_vocabulary("condicion_climatica", weather.CONDITIONS, weather.UNKNOWN_CONDITION)
    return observations(s).select("observacion_id", checked.alias("condicion_climatica"))


@query("f9_f12_sensor_rules", f"""SELECT observacion_id, {_MAX} AS sin_error, CAST(CASE WHEN precipitacion_mm < 0 THEN 0 ELSE precipitacion_mm END AS DECIMAL(6,1)) AS lluvia,
    CASE WHEN humedad_pct BETWEEN 0 AND 100 THEN humedad_pct END AS humedad,
    CASE WHEN temp_min > temp_max THEN temp_max ELSE temp_min END AS menor, CASE WHEN temp_min > temp_max THEN temp_min ELSE temp_max END AS mayor FROM ({OBSERVATIONS_SQL})""")
def sensor_expressions(s: Source):
    low, high = ordered_pair("temp_min", "temp_max")
    return observations(s).select(
        "observacion_id", sentinel_to_null("temp_max", -99).alias("sin_error"),
        negative_to_zero("precipitacion_mm").cast("decimal(6,1)").alias("lluvia"),
        outside_to_null("humedad_pct", 0, 100).alias("humedad"), low.alias("menor"), high.alias("mayor"))


@query("x1_sensor_rules", f"WITH obs AS ({OBSERVATIONS_SQL}) {_CLEAN}")
def sensor_rules(s: Source):
    """The whole row script as column expressions."""
    return select_values(weather.sensor_rules(observations(s)), weather.COLUMNS)


@query("d16_weather_clean", _STAGES + "SELECT * FROM unico")
def weather_clean(s: Source):
    return weather.accepted(_classified(s))


@query("d16_orphan_log", _STAGES + "SELECT *, -1 AS lkp_estacion FROM con_dato WHERE estacion_id IS NULL OR estacion_id NOT IN (SELECT estacion_id FROM est)")
def orphan_log(s: Source):
    log = weather.orphan_log(_classified(s))
    return log.withColumn("lkp_estacion", F.col("lkp_estacion").cast("int"))


@query("d16_discarded", _STAGES + "SELECT * FROM limpio WHERE temp_max IS NULL AND temp_min IS NULL AND precipitacion_mm IS NULL")
def discarded(s: Source):
    return weather.discarded(_classified(s))


@query("d16_staging", _STAGES + "SELECT * FROM unico WHERE ciudad IS NOT NULL")
def weather_staging(s: Source):
    """Staging loaded with the first two weeks, then with everything, twice.

    Rows without a city have no key; ``d16_rejected_keys`` lists them.
    """
    classified = written(_classified(s), "weather")
    clean = weather.accepted(classified)
    staging = weather.with_key(weather.accepted(classified.filter("fecha < '2024-01-15'")))
    once = weather.load_staging(staging, clean)
    return weather.load_staging(once, clean)


@query("d16_rejected_keys", _STAGES + "SELECT * FROM unico WHERE ciudad IS NULL")
def weather_rejected_keys(s: Source):
    """Clean rows that cannot be merged by date and city; with the staging rows they are all that was accepted."""
    return weather.without_key(weather.accepted(_classified(s)))


_CLIMATE = _STAGES + """SELECT fecha, ciudad, CAST(year(fecha) AS INT) AS anio, CAST(month(fecha) AS INT) AS mes, CAST(dayofyear(fecha) AS INT) AS dia_del_anio,
    temp_max, temp_min, temp_media, precipitacion_mm, humedad_pct, velocidad_viento_kmh, condicion_climatica,
    COALESCE(precipitacion_mm > 1.0, FALSE) AS es_dia_lluvia,
    CASE WHEN temp_media IS NULL THEN 'Desconocida' WHEN temp_media < 0 THEN 'Muy fria' WHEN temp_media < 10 THEN 'Fria'
      WHEN temp_media < 20 THEN 'Templada' ELSE 'Calurosa' END AS categoria_temperatura FROM unico"""


@query("d17_climate_dim", _CLIMATE + " WHERE ciudad IS NOT NULL")
def climate_dim(s: Source):
    """Climate dimension after two loads of the same staging rows."""
    clean = written(weather.accepted(_classified(s)), "clean")
    first = weather.climate_rows(weather.with_key(clean)).filter("fecha < '2024-01-15'")
    return weather.load_climate(weather.load_climate(first, clean), clean)


@query("d17_climate_rows", _CLIMATE)
def climate_rows(s: Source):
    return weather.climate_rows(weather.accepted(_classified(s)))


_NAME = "array_to_string(list_transform(string_split(trim(nombre_cliente), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_TYPE = "CASE tipo_cliente WHEN 'mayorista' THEN 'Mayorista' WHEN 'distribuidor' THEN 'Distribuidor' WHEN 'minorista' THEN 'Minorista' WHEN 'retail' THEN 'Retail' ELSE tipo_cliente END"
_GOOD = f"""SELECT cliente_id AS clienteid, {_NAME} AS nombrecliente, {_TYPE} AS tipocliente, canal, segmento, pais AS paiscliente, ciudad AS ciudadcliente,
    lower(trim(email)) AS email, telefono FROM ({CUSTOMERS_SQL}) WHERE email LIKE '%@%'"""


@query("d18_customers_clean", _GOOD)
def customers_clean(s: Source):
    return customer_plans.split_by_email(customers(s))[0]


@query("d18_error_log", f"""SELECT cliente_id AS clienteid, lower(trim(email)) AS email, 'email inválido o nulo' AS motivo FROM ({CUSTOMERS_SQL})
    WHERE email IS NULL OR email NOT LIKE '%@%'""")
def error_log(s: Source):
    """Error log of two runs: the second adds nothing."""
    errors = customer_plans.split_by_email(customers(s))[1]
    once = customer_plans.load_errors(errors.filter(F.lit(False)), errors)
    return customer_plans.load_errors(once, errors)


_DIM_OLD = "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS cliente_sk, c_custkey AS cliente_id, c_name AS nombre_cliente FROM customer WHERE c_acctbal >= 0"


@query("d18_dimension", f"""WITH viejo AS ({_DIM_OLD}), bueno AS ({_GOOD}),
    mezcla AS (SELECT v.cliente_sk, COALESCE(v.cliente_id, b.clienteid) AS cliente_id, COALESCE(b.nombrecliente, v.nombre_cliente) AS nombre_cliente,
      b.tipocliente AS tipo_cliente, b.email FROM viejo v FULL JOIN bueno b ON v.cliente_id = b.clienteid)
    SELECT * FROM mezcla WHERE cliente_sk IS NOT NULL UNION ALL
    SELECT CAST((SELECT MAX(cliente_sk) FROM viejo) + row_number() OVER (ORDER BY cliente_id) AS BIGINT), cliente_id, nombre_cliente, tipo_cliente, email
    FROM mezcla WHERE cliente_sk IS NULL""")
def customer_dimension(s: Source):
    """Cleaned customers merged into a dimension that holds a part of them already."""
    from ..operators.keys import assign_sk

    staging, _ = customer_plans.split_by_email(customers(s))
    known = s.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nombre_cliente"),
        *[F.lit(None).cast("string").alias(c) for c in customer_plans.DIM_NAMES.values() if c not in ("cliente_id", "nombre_cliente")])
    dim = customer_plans.load_dimension(assign_sk(known, "cliente_sk", ["cliente_id"]), staging)
    return dim.select("cliente_sk", "cliente_id", "nombre_cliente", "tipo_cliente", "email")
