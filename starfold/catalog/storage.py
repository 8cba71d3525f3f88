"""Sources and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import money, number_text
from ..plans.kpi import kpi_report, write_report
from ..plans.questions import QUESTIONS, ask_star
from ..operators.joins import any_null
from ..schemas import OLTP, SNOW, STAR
from ..session import scratch_path
from ..sinks import VersionedLayer, append, append_rejects, read_rejects, write_csv_report, write_partitioned
from ..sources import conform, inline_table, read_csv_checked, read_csv_typed, read_query, register_views, series
from .questions import KPI_SQL, TARGETS
from .registry import Source, query
from .sql import with_views


@query("s1_sql_query", "SELECT c_mktsegment, COUNT(*) AS pedidos FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def sql_query(s: Source):
    """SQL text over DataFrames."""
    return read_query(
        s.spark, "SELECT c_mktsegment, COUNT(*) AS pedidos FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment",
        orders=s.orders, customer=s.customer)


@query("s1_registered_views", "SELECT n_name, COUNT(*) AS clientes FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def registered_views(s: Source):
    """SQL text over registered layer views."""
    register_views({"customer": s.customer, "nation": s.nation}, prefix="src_")
    return read_query(s.spark, "SELECT n_name, COUNT(*) AS clientes FROM src_customer JOIN src_nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("s2_csv_locale", "SELECT c_custkey AS cliente_id, c_name AS nombre, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo FROM customer")
def csv_locale(s: Source):
    """Semicolon CSV with decimal comma and grouped thousands, read with declared types."""
    path = scratch_path(s.spark, "csv")
    grouped = F.translate(F.format_number(money("c_acctbal"), 2), ",.", ".,")
    rows = s.customer.select(F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nombre"), grouped.alias("saldo"))
    rows.write.option("sep", ";").option("header", True).csv(path)
    return read_csv_typed(s.spark, path, "cliente_id BIGINT, nombre STRING, saldo DECIMAL(12,2)")


@query("s2_rejects", """SELECT c_custkey AS cliente_id, CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS saldo,
    CASE WHEN c_acctbal < 0 THEN '(' || CAST(CAST(-c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || ')' END AS rechazado FROM customer""")
def csv_rejects(s: Source):
    """Debts in an accountant's parentheses cannot be read as numbers: those rows are told apart, with their text."""
    path = scratch_path(s.spark, "csv")
    balance, debt = money("c_acctbal").cast("string"), F.concat(F.lit("("), money(-F.col("c_acctbal")).cast("string"), F.lit(")"))
    rows = s.customer.select(F.col("c_custkey").alias("cliente_id"), F.when(F.col("c_acctbal") < 0, debt).otherwise(balance).alias("saldo"))
    rows.write.option("sep", ";").option("header", True).csv(path)
    checked = read_csv_checked(s.spark, path, "cliente_id BIGINT, saldo DECIMAL(12,2)", decimal=".", group="")
    return checked.select("cliente_id", "saldo", F.col("errors")["saldo"].alias("rechazado"))


@query("s3_csv_plain", "SELECT o_orderkey AS estacion_id, o_orderstatus = 'O' AS activa, CAST(o_orderdate AS DATE) AS fecha_instalacion, CAST(o_totalprice AS DECIMAL(12,2)) AS latitud FROM orders")
def csv_plain(s: Source):
    """Comma CSV with boolean, date and decimal columns."""
    path = scratch_path(s.spark, "csv")
    s.orders.select(
        F.col("o_orderkey").alias("estacion_id"), (F.col("o_orderstatus") == "O").alias("activa"),
        F.to_date("o_orderdate").alias("fecha_instalacion"), money("o_totalprice").alias("latitud"),
    ).write.option("header", True).csv(path)
    return read_csv_typed(s.spark, path, "estacion_id BIGINT, activa BOOLEAN, fecha_instalacion DATE, latitud DECIMAL(12,2)",
                          sep=",", decimal=".", group="")


@query("s4_series", """SELECT CAST(d AS DATE) AS fecha, COUNT(o_orderkey) AS pedidos FROM
    (SELECT unnest(generate_series((SELECT MIN(o_orderdate) FROM orders), (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1""")
def every_day(s: Source):
    """Orders of every day between the first and the last one, days without any included."""
    days = s.orders.select("o_orderkey", F.to_date("o_orderdate").alias("fecha"))
    first, length = days.agg(F.min("fecha"), F.datediff(F.max("fecha"), F.min("fecha"))).first()
    calendar = series(s.spark, 0, length).select(F.date_add(F.lit(first), F.col("g").cast("int")).alias("fecha"))
    counts = days.groupBy("fecha").agg(F.count(F.lit(1)).alias("n"))
    return calendar.join(counts, "fecha", "left").select("fecha", F.coalesce("n", F.lit(0)).alias("pedidos"))


@query("s5_inline_table", "SELECT p_partkey, objetivo_ingresos FROM part JOIN (VALUES " + ", ".join(f"('{f}', {t})" for f, t in TARGETS) + ") t(f, objetivo_ingresos) ON f = p_type")
def inline(s: Source):
    targets = inline_table(s.spark, TARGETS, "p_type string, objetivo_ingresos int")
    return s.part.join(targets, "p_type").select("p_partkey", "objetivo_ingresos")


@query("s6_declared_schema", with_views("pedidos", """SELECT pedido_id, cliente_id, cliente_id AS contrato_id, fecha_pedido, CAST(fecha_pedido + 4 AS DATE) AS fecha_entrega_solicitada,
    CASE o_orderstatus WHEN 'O' THEN 'pendiente' WHEN 'P' THEN 'enviado' ELSE 'entregado' END AS estado, o_orderpriority AS observaciones
    FROM pedidos JOIN (SELECT o_orderkey + 1 AS pedido_id, o_orderpriority FROM orders) USING (pedido_id)"""))
def declared_schema(s: Source):
    return conform(s.warehouse.oltp["pedidos"], OLTP["pedidos"].schema)


@query("k1_append", "SELECT o_orderstatus, COUNT(*) AS pedidos FROM orders GROUP BY o_orderstatus")
def appended(s: Source):
    """A table appended to in two slices."""
    path = scratch_path(s.spark, "append")
    append(s.orders.filter("o_orderdate < '1998-01-01'"), path)
    append(s.orders.filter("o_orderdate >= '1998-01-01'"), path)
    return s.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("pedidos"))


@query("k2_append_rejects", "SELECT run_id, COUNT(*) AS filas FROM orders JOIN lineitem ON l_orderkey = o_orderkey, (SELECT unnest(['run-1', 'run-2']) AS run_id) "
       "WHERE l_shipdate < o_orderdate GROUP BY run_id")
def appended_rejects(s: Source):
    """Rejects of two runs stay apart by their run identifier."""
    orders = s.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rejects = s.lineitem.join(orders, "l_orderkey").filter("l_shipdate < o_orderdate")
    path = scratch_path(s.spark, "rejects")
    for run in ("run-1", "run-2"):
        append_rejects(rejects, path, run)
    return s.spark.read.parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("filas"))


@query("k3_discard", "SELECT COUNT(*) AS conservadas FROM lineitem WHERE l_returnflag <> 'R'")
def discard(s: Source):
    """A discarded branch is just not written."""
    return s.lineitem.filter("l_returnflag <> 'R'").agg(F.count(F.lit(1)).alias("conservadas"))


@query("k4_csv_round_trip", "SELECT c_custkey AS cliente_id, c_name AS nombre, CAST(c_acctbal AS DECIMAL(12,2)) AS saldo FROM customer")
def csv_round_trip(s: Source):
    path = scratch_path(s.spark, "report")
    rows = s.customer.select(F.col("c_custkey").alias("cliente_id"), F.col("c_name").alias("nombre"), money("c_acctbal").alias("saldo"))
    write_csv_report(rows, path, masks={"saldo": number_text("saldo", 2, symbol=",")}, order_by=[F.desc("saldo"), "cliente_id"])
    return read_csv_typed(s.spark, path, "cliente_id BIGINT, nombre STRING, saldo DECIMAL(12,2)")


@query("k4_kpi_file", KPI_SQL)
def kpi_file(s: Source):
    """The KPI report written with its masks and read back whole: amounts with a point, percentages with a comma."""
    targets = inline_table(s.spark, TARGETS, "familia_producto string, objetivo_ingresos int")
    path = scratch_path(s.spark, "kpi")
    write_report(kpi_report(ask_star(s.warehouse.star, QUESTIONS["a7"]), targets), path)
    amounts = "ingresos_reales DECIMAL(24,2), costes_totales DECIMAL(24,2), margen_total DECIMAL(24,2)"
    report = read_csv_typed(s.spark, path, f"familia_producto STRING, {amounts}, objetivo INT, pct_margen STRING, pct_objetivo STRING",
                            decimal=".", group="")
    percents = {c: F.regexp_replace(c, "^(-?[0-9]*),", "$1.").cast("decimal(28,10)") for c in ("pct_margen", "pct_objetivo")}
    return report.withColumns(percents)


@query("k2_empty_rejects", "SELECT CAST(0 AS BIGINT) AS filas")
def empty_rejects(s: Source):
    """A run that rejects nothing leaves a log that can be read."""
    path = scratch_path(s.spark, "rejects")
    rejects = s.lineitem.filter("l_quantity < 0")
    append_rejects(rejects, path, "run-1")
    return read_rejects(s.spark, path, rejects.schema).agg(F.count(F.lit(1)).alias("filas"))


@query("k6_empty_increment", "SELECT CAST(year(o_orderdate) AS INT) AS anio, COUNT(*) AS pedidos FROM orders GROUP BY 1")
def empty_increment(s: Source):
    """A load without rows changes nothing, before or after others."""
    orders = s.orders.withColumn("anio", F.year("o_orderdate"))
    layer, by = VersionedLayer(s.spark, scratch_path(s.spark, "layer")), {"pedidos": ["anio"]}
    nothing = orders.filter("o_orderkey < 0")
    layer.publish({"pedidos": nothing}, partition_by=by)
    layer.publish(append={"pedidos": orders}, partition_by=by)
    layer.publish(append={"pedidos": nothing}, partition_by=by)
    return layer.read("pedidos").groupBy("anio").agg(F.count(F.lit(1)).alias("pedidos"))


@query("k5_rebuild_layer", "SELECT c_mktsegment, COUNT(*) AS clientes, CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS deudores FROM customer GROUP BY c_mktsegment")
def rebuilt_layer(s: Source):
    """A layer rebuilt as a new version: readers get the last published one."""
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "layer"))
    layer.publish({"clientes": s.customer.limit(0)})
    layer.publish({"clientes": s.customer})
    deudor = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    return layer.read("clientes").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("clientes"), F.sum(deudor).alias("deudores"))


@query("k6_incremental_version", "SELECT CAST(year(o_orderdate) AS INT) AS anio, COUNT(*) AS pedidos FROM orders GROUP BY 1")
def incremental_version(s: Source):
    """A version that adds rows to a table without rewriting those of earlier versions."""
    orders = s.orders.withColumn("anio", F.year("o_orderdate"))
    layer = VersionedLayer(s.spark, scratch_path(s.spark, "layer"))
    layer.publish({"pedidos": orders.filter("anio < 1998")}, partition_by={"pedidos": ["anio"]})
    layer.publish(append={"pedidos": orders.filter("anio >= 1998")}, partition_by={"pedidos": ["anio"]})
    return layer.read("pedidos").groupBy("anio").agg(F.count(F.lit(1)).alias("pedidos"))


@query("k_partitioned_write", "SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, COUNT(*) AS lineas FROM lineitem GROUP BY 1")
def partitioned_write(s: Source):
    path = scratch_path(s.spark, "partitioned")
    write_partitioned(s.lineitem, path, ["l_returnflag"])
    return s.spark.read.parquet(path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lineas"))


#: Rows of every declared table, in terms of the given tables.
_ROWS = {
    **dict.fromkeys(("fincas", "transitarios", "rutas_logisticas"), "SELECT COUNT(*) FROM supplier"), "parcelas": "SELECT 2 * COUNT(*) FROM supplier",
    **dict.fromkeys(("cultivos", "cosechas", "lotes_origen", "lotes", "controles_calidad", "certificados", "costes_lote"), "SELECT COUNT(*) FROM part"),
    **dict.fromkeys(("calibres", "tarifas"), "SELECT 4 * COUNT(*) FROM part"), "incidencias_calidad": "SELECT COUNT(*) FROM lotes WHERE lote_id % 5 = 0",
    **dict.fromkeys(("clientes", "contratos"), "SELECT COUNT(*) FROM customer"), "pedidos": "SELECT COUNT(*) FROM orders",
    "detalle_pedido": "SELECT COUNT(*) FROM lineitem", "campanias": "SELECT COUNT(*) FROM dim_campania", "puertos": "SELECT COUNT(*) FROM nation",
    **dict.fromkeys(("envios", "aduanas", "costes_logisticos"), "SELECT COUNT(*) FROM envios"),
    "incidencias_envio": "SELECT COUNT(*) FROM envios WHERE pedido_id % 4 = 0", **dict.fromkeys(("facturas", "cobros"), "SELECT COUNT(*) FROM totales"),
    "tipos_cambio": "SELECT COUNT(*) FROM dim_tiempo",
    "dim_tiempo": "SELECT COUNT(*) FROM dim_tiempo", "dim_campania": "SELECT COUNT(*) FROM dim_campania", "dim_cliente": "SELECT COUNT(*) FROM customer",
    "dim_geografia": "SELECT COUNT(*) FROM dim_geografia", "dim_finca": "SELECT 2 * COUNT(*) FROM supplier", "dim_producto": "SELECT COUNT(*) FROM part",
    "dim_calidad": "SELECT COUNT(*) FROM part", "dim_logistica": "SELECT COUNT(*) FROM supplier", "fact_exportaciones": "SELECT COUNT(*) FROM lineitem",
    "dim_familia_producto": "SELECT COUNT(DISTINCT p_type) FROM part",
}
_LAYERS = {"oltp": OLTP, "star": STAR, "snow": SNOW}
_ALL_TABLES = " UNION ALL ".join(
    f"SELECT '{layer}' AS capa, '{name}' AS tabla, {len(table.names)} AS columnas, CAST(n AS BIGINT) AS filas, CAST(n AS BIGINT) AS completas FROM ({_ROWS[name]}) t(n)"
    for layer, tables in _LAYERS.items() for name, table in tables.items())


@query("s6_all_tables", with_views("dim_campania", f"SELECT * FROM (WITH a AS (SELECT 1 FROM lotes LIMIT 0), b AS (SELECT 1 FROM envios LIMIT 0), "
       f"c AS (SELECT 1 FROM totales LIMIT 0), d AS (SELECT 1 FROM dim_tiempo LIMIT 0), e AS (SELECT 1 FROM dim_campania LIMIT 0), "
       f"f AS (SELECT 1 FROM dim_geografia LIMIT 0) {_ALL_TABLES})"))
def all_declared_schemas(s: Source):
    """Every declared table of the three layers in its declared schema: rows, and rows that lack no required column."""
    out = None
    for layer, declared in _LAYERS.items():
        for name, table in declared.items():
            rows = conform(s.warehouse.served(getattr(s.warehouse, layer), name), table.schema)
            required = [f.name for f in table.schema.fields if not f.nullable]
            whole = F.count(F.when(~any_null(required), 1)) if required else F.count(F.lit(1))
            one = rows.agg(F.count(F.lit(1)).alias("filas"), whole.alias("completas")).select(
                F.lit(layer).alias("capa"), F.lit(name).alias("tabla"), F.lit(len(table.names)).alias("columnas"), "filas", "completas")
            out = one if out is None else out.unionByName(one)
    return out
