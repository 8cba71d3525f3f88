"""Loads into stored layers: the increment as one job, stored aggregates, merged parts, key registries, retention."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.jobs import RUNS, clean_weather, load_customers
from ..plans.key_checks import all_repeated, check_references, check_unique
from ..plans.load import FACT, QUARTERLY, apply_increment, publish_models
from ..session import CODEC, scratch_path, written
from ..sinks import VersionedLayer, append_rejects, merge_parts, stable_keys, write_parts
from .cleaning import _CLIMATE, _GOOD, _STAGES
from .dirty import CUSTOMERS_SQL, customers, observations, stations
from .merging import _UPSERTED, _source, _target
from .model import _CUTOFF, _FACT_SQL, _OVERLAP
from .questions import question_body, question_sql
from .registry import Source, query
from .sql import with_views

_LATE, _EARLY = "detalle_id % 100 > 3", "detalle_id % 100 <= 3"


def first_load(s: Source) -> tuple[dict, dict, dict]:
    """Order tables and both models with the orders before the cut-off, of which only the first three lines have come."""
    w = s.warehouse
    known = w.oltp["pedidos"].filter(F.col("fecha_pedido") < _CUTOFF)
    ids = known.select("pedido_id")
    shipped = w.oltp["envios"].join(ids, "pedido_id", "left_semi")
    oltp = {
        "pedidos": known, "detalle_pedido": w.oltp["detalle_pedido"].filter(_EARLY).join(ids, "pedido_id", "left_semi"),
        "envios": shipped, "costes_logisticos": w.oltp["costes_logisticos"].join(shipped.select("envio_id"), "envio_id", "left_semi")}
    models = []
    for model, fact in ((w.star, w.fact_of_both), (w.snow, w.snow[FACT])):
        old = fact.filter(f"anio_pedido < {_CUTOFF[:4]} AND {_EARLY}")
        models.append({**{n: model[n] for n in model}, FACT: old, "dim_tiempo": model["dim_tiempo"].filter(F.col("fecha") < _CUTOFF)})
    return oltp, *models


def second_load(s: Source) -> dict[str, DataFrame]:
    """All orders from before the cut-off on, with their lines, shipments and costs, and the late lines of the earlier orders: stored, as sent."""
    w = s.warehouse
    recent = w.oltp["pedidos"].filter(F.col("fecha_pedido") >= _OVERLAP)
    ids = recent.select("pedido_id")
    lines, late = w.oltp["detalle_pedido"], F.coalesce(F.expr(_LATE), F.lit(False))
    recent_lines = lines.filter(~late).join(ids, "pedido_id", "left_semi").select(*lines.columns)
    shipped = written(w.oltp["envios"].join(ids, "pedido_id", "left_semi"), "sent-envios")
    costs = w.oltp["costes_logisticos"].join(shipped.select("envio_id"), "envio_id", "left_semi")
    return {"pedidos": recent, "detalle_pedido": written(recent_lines.unionByName(lines.filter(late)), "sent-detalle_pedido", CODEC),
            "envios": shipped, "costes_logisticos": written(costs, "sent-costes_logisticos")}


_layers: dict[tuple[str, str, str], VersionedLayer] = {}


def _once(s: Source, name: str, build: Callable[[], VersionedLayer]) -> VersionedLayer:
    """A layer that several queries read is built once in a Spark application."""
    key = (s.spark.sparkContext.applicationId, s.folder, name)
    if key not in _layers:
        _layers[key] = build()
    return _layers[key]


def loaded_layer(s: Source) -> VersionedLayer:
    """A layer after the first load and the second one, sent three times: twice under its name, then under another."""
    def build() -> VersionedLayer:
        layer = VersionedLayer(s.spark, scratch_path(s.spark, "models"))
        publish_models(layer, "first", *first_load(s))
        changes = second_load(s)
        for load_id in ("second", "second", "second sent again"):
            apply_increment(layer, load_id, changes, s.warehouse.oltp)
        return layer

    return _once(s, "models", build)


#: table -> (column summed up as a control, the same in SQL, view)
_CONTROLS = {
    "oltp.pedidos": ("pedido_id", "pedido_id", "pedidos"), "oltp.detalle_pedido": ("importe_neto", "neto", "detalle"),
    "oltp.envios": ("kilos_totales", "kilos_pedido", "envios"), "oltp.costes_logisticos": ("envio_id", "pedido_id", "costes_envio"),
    "star.dim_tiempo": ("tiempo_sk", "tiempo_sk", "dim_tiempo"), "snow.dim_tiempo": ("tiempo_sk", "tiempo_sk", "dim_tiempo"),
    "star.fact_exportaciones": ("margen", "margen", "hechos"), "snow.fact_exportaciones": ("tiempo_sk", "tiempo_sk", "hechos_sk"),
    "star.ingresos_trimestre": ("margen", "margen", "trimestres"), "rechazos.detalle_pedido": ("detalle_id", "detalle_id", "nada"),
}


def _controls_sql() -> str:
    one = [f"SELECT '{table}' AS tabla, COUNT(*) AS filas, CAST(COALESCE(SUM({column}), 0) AS DECIMAL(24,2)) AS control FROM {view}"
           for table, (_, column, view) in _CONTROLS.items()]
    body = " UNION ALL ".join(one)
    return with_views("hechos_sk", f"""SELECT * FROM (WITH trimestres AS ({question_body('a6', True)}),
        nada AS (SELECT 0 AS detalle_id WHERE FALSE), f AS (SELECT 1 FROM costes_envio LIMIT 0), g AS (SELECT 1 FROM hechos_sk LIMIT 0),
        h AS (SELECT 1 FROM dim_tiempo LIMIT 0) {body})""")


@query("k6_apply_increment", _controls_sql())
def increment_controls(s: Source):
    """Row counts and sums of every table that the load publishes, read back from its version."""
    layer, out = loaded_layer(s), None
    for table, (column, _, _) in _CONTROLS.items():
        total = F.coalesce(F.sum(column), F.lit(0)).cast("decimal(24,2)").alias("control")
        one = layer.read(table).agg(F.count(F.lit(1)).alias("filas"), total).select(F.lit(table).alias("tabla"), "filas", "control")
        out = one if out is None else out.unionByName(one)
    return out


@query("k6_increment_fact", _FACT_SQL)
def increment_fact(s: Source):
    return loaded_layer(s).read(f"star.{FACT}")


@query("k6_increment_snow_fact", _FACT_SQL)
def increment_snow_fact(s: Source):
    return loaded_layer(s).read(f"snow.{FACT}")


@query("d15_stored_incremental", question_sql("a6", stored=True))
def stored_aggregate(s: Source):
    """The aggregate as the loads have left it in its table; another refresh finds nothing to do."""
    layer = loaded_layer(s)
    QUARTERLY.refresh_layer(layer)
    return layer.read(QUARTERLY.name)


@query("d15_stored_full", question_sql("a6", stored=True))
def rebuilt_aggregate(s: Source):
    layer = loaded_layer(s)
    QUARTERLY.refresh_layer(layer, "full")
    return layer.read(QUARTERLY.name)


_FIRST_WEEKS = "fecha < '2024-01-15'"
_OUTCOMES = ("accepted", "orphan", "discarded", "without_key")


def _runs_sql() -> str:
    names = ", ".join(f"('{o}')" for o in _OUTCOMES)
    return _STAGES + f""", clase AS (SELECT *, CASE WHEN temp_max IS NULL AND temp_min IS NULL AND precipitacion_mm IS NULL THEN 'discarded'
      WHEN estacion_id IS NULL OR estacion_id NOT IN (SELECT estacion_id FROM est) THEN 'orphan'
      WHEN fecha IS NULL OR ciudad IS NULL THEN 'without_key' ELSE 'accepted' END AS outcome FROM limpio),
    filas AS (SELECT 'run-1' AS run_id, outcome FROM clase WHERE {_FIRST_WEEKS} UNION ALL SELECT 'run-2', outcome FROM clase)
    SELECT r.run_id, o.outcome, COUNT(f.outcome) AS filas FROM (VALUES ('run-1'), ('run-2')) r(run_id) CROSS JOIN (VALUES {names}) o(outcome)
    LEFT JOIN filas f ON f.run_id = r.run_id AND f.outcome = o.outcome GROUP BY ALL"""


def weather_layer(s: Source) -> VersionedLayer:
    """The weather job over the first two weeks, then over everything, the latter sent twice."""
    def build() -> VersionedLayer:
        layer, rows = VersionedLayer(s.spark, scratch_path(s.spark, "meteo")), observations(s)
        clean_weather(layer, "run-1", rows.filter(_FIRST_WEEKS), stations(s), rows_per_part=500)
        for _ in range(2):
            clean_weather(layer, "run-2", rows, stations(s), rows_per_part=500)
        return layer

    return _once(s, "meteo", build)


@query("d16_run", _runs_sql())
def weather_run(s: Source):
    """Rows of every run by outcome, as the job has logged them."""
    return weather_layer(s).read(f"meteo.{RUNS}")


@query("d16_run_staging", _STAGES + "SELECT * FROM unico WHERE fecha IS NOT NULL AND ciudad IS NOT NULL")
def weather_run_staging(s: Source):
    return weather_layer(s).read("meteo.staging")


@query("d17_run_climate", _CLIMATE + " WHERE fecha IS NOT NULL AND ciudad IS NOT NULL")
def weather_run_climate(s: Source):
    return weather_layer(s).read("meteo.dim_clima")


@query("k3_run_orphans", _STAGES + f"""SELECT con_dato.*, -1 AS lkp_estacion, r.run_id FROM con_dato, (VALUES ('run-1'), ('run-2')) r(run_id)
    WHERE (estacion_id IS NULL OR estacion_id NOT IN (SELECT estacion_id FROM est)) AND (r.run_id = 'run-2' OR {_FIRST_WEEKS})""")
def weather_run_orphans(s: Source):
    log = weather_layer(s).read("meteo.huerfanas")
    return log.withColumn("lkp_estacion", F.col("lkp_estacion").cast("int"))


def customer_layer(s: Source) -> VersionedLayer:
    """The customer job over two segments, then over all customers, the latter sent twice."""
    def build() -> VersionedLayer:
        layer, rows = VersionedLayer(s.spark, scratch_path(s.spark, "ventas")), customers(s)
        load_customers(layer, "run-1", rows.filter(F.col("segmento").isin("BUILDING", "MACHINERY")), rows_per_part=400)
        for _ in range(2):
            load_customers(layer, "run-2", rows, rows_per_part=400)
        return layer

    return _once(s, "ventas", build)


@query("d18_run", f"""WITH clase AS (SELECT segmento, CASE WHEN email IS NOT NULL AND email LIKE '%@%' THEN 'accepted' ELSE 'bad_email' END AS outcome FROM ({CUSTOMERS_SQL})),
    filas AS (SELECT 'run-1' AS run_id, outcome FROM clase WHERE segmento IN ('BUILDING', 'MACHINERY') UNION ALL SELECT 'run-2', outcome FROM clase)
    SELECT r.run_id, o.outcome, COUNT(f.outcome) AS filas FROM (VALUES ('run-1'), ('run-2')) r(run_id)
    CROSS JOIN (VALUES ('accepted'), ('bad_email'), ('without_key')) o(outcome)
    LEFT JOIN filas f ON f.run_id = r.run_id AND f.outcome = o.outcome GROUP BY ALL""")
def customer_run(s: Source):
    """Rows of every run by outcome, as the job has logged them."""
    return customer_layer(s).read(f"ventas.{RUNS}")


@query("d18_run_dimension", f"""SELECT CAST(row_number() OVER (ORDER BY segmento NOT IN ('BUILDING', 'MACHINERY'), clienteid) AS BIGINT) AS cliente_sk,
    clienteid AS cliente_id, nombrecliente AS nombre_cliente, tipocliente AS tipo_cliente, canal, segmento, paiscliente AS pais_cliente,
    ciudadcliente AS ciudad_cliente, email, telefono FROM ({_GOOD})""")
def customer_run_dimension(s: Source):
    """The second run keeps the keys that the first one has given."""
    return customer_layer(s).read("ventas.dim_cliente")


@query("d18_run_errors", f"""SELECT cliente_id AS clienteid, lower(trim(email)) AS email, 'email inválido o nulo' AS motivo FROM ({CUSTOMERS_SQL})
    WHERE email IS NULL OR email NOT LIKE '%@%'""")
def customer_run_errors(s: Source):
    return customer_layer(s).read("ventas.errores")


@query("u1_stored_merge", _UPSERTED)
def stored_merge(s: Source):
    """The upsert into a stored table, of which only the parts that the source meets are written anew."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "merged"))
    load = layer.load("base")
    write_parts(load, "clientes", _target(s), ["cliente_id"], rows_per_part=300)
    load.commit()
    for _ in range(2):
        load = layer.load("carga")
        if not load.applied:
            merge_parts(load, "clientes", _source(s), order_by=["version"])
            load.commit()
    return layer.read("clientes")


@query("w2_registry", """WITH compra AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')
    SELECT c_custkey, n_name AS pais, CAST(row_number() OVER (ORDER BY c_custkey NOT IN (SELECT o_custkey FROM compra), n_name, c_custkey) AS BIGINT) AS cliente_sk
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def key_registry(s: Source):
    """Customers numbered as they first come: those of the first orders, then the rest; a rebuild numbers nobody anew."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "registry"))
    every = s.customer.join(s.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("pais"))
    first = s.orders.filter("o_orderdate < '1996-01-01'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    for batch in (every.join(first, "c_custkey", "left_semi"), every, every):
        load = layer.load()
        numbered = stable_keys(load, "clientes.claves", batch.select("c_custkey", "pais"), ["pais", "c_custkey"], "cliente_sk")
        load.commit()
    return numbered.select("c_custkey", "pais", "cliente_sk")


@query("k2_same_run_twice", "SELECT run_id, COUNT(*) AS filas FROM orders JOIN lineitem ON l_orderkey = o_orderkey, (SELECT unnest(['run-1', 'run-2']) AS run_id) "
       "WHERE l_shipdate < o_orderdate GROUP BY run_id")
def rejects_once(s: Source):
    """Every run's rejects sent twice: they are logged once."""
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rejects = s.lineitem.join(orders, "l_orderkey").filter("l_shipdate < o_orderdate")
    path = scratch_path(s.spark, "rejects")
    for run in ("run-1", "run-1", "run-2", "run-2"):
        append_rejects(rejects, path, run)
    return s.spark.read.parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("filas"))


@query("k5_after_retention", "SELECT c_mktsegment, COUNT(*) AS clientes, CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS deudores FROM customer GROUP BY c_mktsegment")
def after_retention(s: Source):
    """A table of two loads after rebuilds and retention: what the kept version refers to is all there."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "layer"))
    layer.publish({"clientes": s.customer})
    layer.publish({"clientes": s.customer.filter("c_acctbal >= 0")})
    layer.publish(append={"clientes": s.customer.filter("c_acctbal < 0")})
    layer.retain(1, grace_seconds=0)
    deudor = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return layer.read("clientes").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("clientes"), F.sum(deudor).alias("deudores"))


def _key_layer(s: Source):
    """Lines loaded in two batches by shipping date, each checked against the summary of the keys before it."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "keys"))
    lines = s.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    for batch in (lines.filter("l_shipdate < '1999-01-01'"), lines.filter("l_shipdate >= '1999-01-01'")):
        load = layer.load()
        check_unique(load, "lineas.claves", batch, ["l_orderkey", "l_linenumber"], rows_per_part=20_000)
        load.commit()
    return layer


@query("q2_increment", "SELECT 'unique:l_orderkey,l_linenumber' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, "
       "CAST(COUNT(*) AS VARCHAR) AS value FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def unique_increment(s: Source):
    return all_repeated(_key_layer(s).load(), "lineas.claves")


@query("q3_increment", """SELECT 'foreign_key:l_partkey' AS rule, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key, CAST(l_partkey AS VARCHAR) AS value
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""")
def reference_increment(s: Source):
    """Lines of the last years against the stored keys of the larger parts."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "keys"))
    load = layer.load()
    check_unique(load, "piezas.claves", s.part.filter("p_size > 10"), ["p_partkey"], rows_per_part=500)
    load.commit()
    batch = s.lineitem.filter("l_shipdate >= '1999-01-01'")
    return check_references(layer.load(), "piezas.claves", batch, ["l_orderkey", "l_linenumber"], ["l_partkey"])
