"""Dimensions, facts and the incremental load."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..operators.lookup import key_map, rekey, resolve_keys, unresolved
from ..plans import star as star_plans
from ..plans.increment import increment, unresolved_lines
from ..plans.retail import CATALOG
from ..plans.snow import NATURAL_KEYS
from ..session import written
from .registry import ORACLES, Source, query
from .sql import CENTRE, SOUTH, quoted, with_views

_CALENDAR = """SELECT t.tiempo_sk, t.fecha, CAST(day(fecha) AS INT) AS dia, CAST(month(fecha) AS INT) AS mes,
    CAST(quarter(fecha) AS INT) AS trimestre, CAST(year(fecha) AS INT) AS anio, CAST(week(fecha) AS INT) AS semana,
    dayname(fecha) AS dia_semana, isodow(fecha) >= 6 AS es_festivo FROM dim_tiempo t"""


@query("d1_calendar", with_views("dim_tiempo", _CALENDAR))
def calendar(s: Source):
    return s.warehouse.star["dim_tiempo"]


@query("d2_campaign", with_views("dim_campania", """SELECT campania_sk, CAST(inicio AS BIGINT) AS campania_id,
    'Campania_' || CAST(inicio AS VARCHAR) || '_' || CAST(inicio + 1 AS VARCHAR) AS nombre_campania,
    make_date(inicio, 9, 1) AS fecha_inicio, make_date(inicio + 1, 8, 31) AS fecha_fin, 'Otono-Primavera' AS temporada,
    CAST(inicio + 1 AS INT) AS anio_agricola, CAST(NULL AS VARCHAR) AS observaciones_climaticas FROM dim_campania"""))
def campaign(s: Source):
    return s.warehouse.star["dim_campania"]


@query("d3_customer", with_views("dim_cliente", """SELECT d.cliente_sk, c.cliente_id, c.nombre_cliente, c.tipo_cliente, c.canal, c.segmento,
    c.pais AS pais_cliente, c.ciudad AS ciudad_cliente, c.email, c.telefono
    FROM clientes c JOIN dim_cliente d ON d.cliente_id = c.cliente_id"""))
def customer(s: Source):
    return s.warehouse.star["dim_cliente"]


@query("d4_geography", with_views("dim_geografia", f"""SELECT geografia_sk, ciudad, ciudad AS provincia,
    CASE WHEN pais IN ({SOUTH}, {CENTRE}) THEN 'Europa Occidental' ELSE 'Otras regiones' END AS region, pais,
    CASE WHEN pais IN ({SOUTH}) THEN 'Sur de Europa' WHEN pais IN ({CENTRE}) THEN 'Centro de Europa'
      ELSE 'Mercado Internacional' END AS zona_comercial,
    CASE WHEN pais IN ({SOUTH}, {CENTRE}) THEN 'Europa' ELSE 'Otro' END AS continente FROM dim_geografia"""))
def geography(s: Source):
    return s.warehouse.star["dim_geografia"]


@query("d5_farm", with_views("dim_finca", """SELECT f.finca_sk, f.s_suppkey + 1 AS finca_id, s_name AS nombre_finca,
    'Parcela_' || lpad(CAST(parcela_id AS VARCHAR), 12, '0') AS parcela,
    CAST(2.50 + (parcela_id % 8) * 0.70 AS DECIMAL(8,2)) AS superficie_hectareas, n_name AS municipio, r_name AS provincia,
    CASE WHEN f.s_suppkey % 2 = 0 THEN 'Costa Mediterranea' ELSE 'Costa Atlantica' END AS zona_agricola,
    list_extract(['Franco-arenoso', 'Franco-arcilloso', 'Limoso', 'Franco'], CAST(f.s_suppkey % 4 + 1 AS INT)) AS tipo_suelo,
    list_extract(['Goteo', 'Aspersion', 'Microaspersion'], CAST(f.s_suppkey % 3 + 1 AS INT)) AS sistema_riego
    FROM dim_finca f JOIN supplier s ON s.s_suppkey = f.s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""))
def farm(s: Source):
    return s.warehouse.star["dim_finca"]


_PUNNET, _BOXED, _BULK = quoted(CATALOG.punnet), quoted(CATALOG.boxed), quoted(CATALOG.bulk)
_PACKING = f"""CASE WHEN p_name IN ({_PUNNET}) THEN 'Tarrina' ELSE 'Caja' END AS tipo_envase,
    CASE WHEN p_name IN ({_BULK}) THEN 'Granel' WHEN p_name IN ({_BOXED}) THEN 'Caja 4kg' ELSE 'Tarrina 500g' END AS formato_comercial,
    CAST(CASE WHEN p_name IN ({_PUNNET}) THEN 0.50 WHEN p_name IN ({_BOXED}) THEN 4.00 ELSE 5.00 END AS DECIMAL(10,2)) AS peso_unidad"""


@query("d6_product", with_views("dim_producto", f"""SELECT d.producto_sk, d.lote_id AS cultivo_id, p_name AS nombre_producto, p_brand AS variedad,
    p_type AS familia_producto, {_PACKING} FROM dim_producto d JOIN part ON p_partkey + 1 = d.lote_id"""))
def product(s: Source):
    return s.warehouse.star["dim_producto"]


@query("d7_quality", with_views("dim_producto", """SELECT d.producto_sk AS calidad_sk, l.lote_id, l.categoria_comercial, l.calibre,
    l.tipo_certificado, l.estado_lote, l.tipo_certificado = 'ECO' AS tiene_certificacion_eco,
    l.tipo_certificado = 'GlobalGAP' AS tiene_certificacion_global_gap FROM lotes l JOIN dim_producto d ON d.lote_id = l.lote_id"""))
def quality(s: Source):
    return s.warehouse.star["dim_calidad"]


@query("d8_logistics", with_views("dim_logistica", """SELECT d.logistica_sk, r.ruta_id, r.nombre_transitario, r.puerto_salida, r.puerto_llegada,
    r.tipo_transporte, r.puerto_salida || ' -> ' || r.puerto_llegada AS ruta_logistica, r.dias_estimados AS duracion_estimada_dias
    FROM rutas r JOIN dim_logistica d ON d.ruta_id = r.ruta_id"""))
def logistics(s: Source):
    return s.warehouse.star["dim_logistica"]


_FACT_SQL = with_views("hechos_sk", "SELECT * FROM hechos_sk")


@query("d9_star_fact", _FACT_SQL)
def star_fact(s: Source):
    return s.warehouse.star["fact_exportaciones"]


@query("d10_family", """SELECT CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS familia_sk, p_type AS familia_producto
    FROM (SELECT DISTINCT p_type FROM part)""")
def family(s: Source):
    return s.warehouse.snow["dim_familia_producto"]


@query("d11_snow_product", f"""WITH f AS (SELECT CAST(row_number() OVER (ORDER BY p_type) AS BIGINT) AS familia_sk, p_type FROM (SELECT DISTINCT p_type FROM part))
    SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS producto_sk, p_partkey + 1 AS cultivo_id, p_name AS nombre_producto,
    p_brand AS variedad, f.familia_sk, {_PACKING} FROM part JOIN f USING (p_type)""")
def snow_product(s: Source):
    return s.warehouse.snow["dim_producto"]


@query("d12_conformed_dimension", with_views("dim_logistica", """SELECT d.logistica_sk, r.ruta_id, r.nombre_transitario, r.puerto_salida, r.puerto_llegada,
    r.tipo_transporte, r.puerto_salida || ' -> ' || r.puerto_llegada AS ruta_logistica, r.dias_estimados AS duracion_estimada_dias
    FROM rutas r JOIN dim_logistica d ON d.ruta_id = r.ruta_id"""))
def conformed_dimension(s: Source):
    return s.warehouse.snow["dim_logistica"]


# The other six conformed copies, whole.
for _name, _original in {"dim_tiempo": "d1_calendar", "dim_campania": "d2_campaign", "dim_cliente": "d3_customer", "dim_geografia": "d4_geography",
                         "dim_finca": "d5_farm", "dim_calidad": "d7_quality"}.items():
    query(f"d12_{_name}", ORACLES[_original])(lambda s, n=_name: s.warehouse.snow[n])


@query("d13_snow_fact", _FACT_SQL)
def snow_fact(s: Source):
    return s.warehouse.snow["fact_exportaciones"]


_CUTOFF, _OVERLAP = "2000-01-01", "1999-07-01"


@query("d14_increment", _FACT_SQL)
def incremental_load(s: Source):
    """Orders of the last years loaded into a warehouse of the first ones.

    The batch overlaps what is loaded already, and is applied twice: neither may
    add a line again.
    """
    return _loaded_in_two_steps(s, s.warehouse.star)


@query("d14_snow_increment", _FACT_SQL)
def incremental_snow_load(s: Source):
    """The same load into the snowflake model."""
    return _loaded_in_two_steps(s, s.warehouse.snow)


def _loaded_in_two_steps(s: Source, model):
    w = s.warehouse
    fact, calendar_ = model["fact_exportaciones"], model["dim_tiempo"]
    base = fact.filter(F.col("anio_pedido") < int(_CUTOFF[:4]))
    dims = {**{n: model[n] for n in NATURAL_KEYS}, "dim_tiempo": calendar_.filter(F.col("fecha") < _CUTOFF)}
    batch = w.oltp["pedidos"].filter(F.col("fecha_pedido") >= _OVERLAP)
    for _ in range(2):
        days, rows = increment(w.oltp, dims, base, batch)
        dims["dim_tiempo"] = dims["dim_tiempo"].unionByName(written(days, "days"))
        base = base.unionByName(written(rows, "increment"))  # what the next load and the answer read is not joined again
    return base


@query("d14_late_lines", _FACT_SQL)
def late_lines(s: Source):
    """The first three lines of every order are loaded, the others arrive later and are loaded twice."""
    w = s.warehouse
    base = w.star["fact_exportaciones"].filter("detalle_id % 100 <= 3")
    for _ in range(2):
        _, rows = increment(w.oltp, w.star, base, w.oltp["pedidos"])
        base = base.unionByName(written(rows, "increment"))
    return base


@query("d14_unresolved", with_views("hechos", """SELECT h.detalle_id, h.pedido_id, h.lote_id FROM hechos h
    WHERE h.cliente_id NOT IN (SELECT c_custkey + 1 FROM customer WHERE c_acctbal >= 0)"""))
def unresolved_in_load(s: Source):
    """Lines that a load into a model without the indebted customers leaves out."""
    w = s.warehouse
    solvent = s.customer.filter("c_acctbal >= 0").select((F.col("c_custkey") + 1).alias("cliente_id"))
    dims = {**{n: w.star[n] for n in NATURAL_KEYS}, "dim_cliente": sized_join(w.star["dim_cliente"], solvent, "cliente_id", "left_semi")}
    _, rows = increment(w.oltp, dims, w.star["fact_exportaciones"].limit(0), w.oltp["pedidos"])
    return unresolved_lines(w.oltp["detalle_pedido"], rows).select("detalle_id", "pedido_id", "lote_id")


@query("d14_calendar_extension", with_views("dim_tiempo", _CALENDAR))
def calendar_extension(s: Source):
    """Calendar of the first years extended by the dates of all orders: known dates keep their key."""
    from ..plans.increment import extend_calendar

    known = s.warehouse.star["dim_tiempo"].filter(F.col("fecha") < _CUTOFF)
    return known.unionByName(extend_calendar(known, s.warehouse.oltp["pedidos"]))


@query("j13_resolve_keys", with_views("dim_logistica", """SELECT p.pedido_id, t.tiempo_sk, c.cliente_sk FROM pedidos p
    JOIN dim_tiempo t ON t.fecha = p.fecha_pedido JOIN dim_cliente c ON c.cliente_id = p.cliente_id"""))
def keys_of_orders(s: Source):
    star = s.warehouse.star
    resolved = resolve_keys(s.warehouse.oltp["pedidos"], {
        "tiempo_sk": (star["dim_tiempo"], {"fecha_pedido": "fecha"}),
        "cliente_sk": (star["dim_cliente"], {"cliente_id": "cliente_id"}),
    })
    return resolved.select("pedido_id", "tiempo_sk", "cliente_sk")


@query("j13_unresolved", with_views("pedidos", """SELECT 'cliente_sk' AS dimension, pedido_id, cliente_id FROM pedidos
    WHERE cliente_id NOT IN (SELECT c_custkey + 1 FROM customer WHERE c_acctbal >= 0)"""))
def unresolved_orders(s: Source):
    """Orders the inner joins of a load would drop, given a dimension without the indebted customers."""
    solvent = s.customer.filter("c_acctbal >= 0").select((F.col("c_custkey") + 1).alias("cliente_id"))
    dim = sized_join(s.warehouse.star["dim_cliente"], solvent, "cliente_id", "left_semi")
    lost = unresolved(s.warehouse.oltp["pedidos"], {"cliente_sk": (dim, {"cliente_id": "cliente_id"})})
    return lost.select("dimension", "pedido_id", "cliente_id")


@query("j14_rekey", with_views("dim_logistica", """SELECT p.pedido_id, t.tiempo_sk + 1000 AS tiempo_sk FROM pedidos p
    JOIN dim_tiempo t ON t.fecha = p.fecha_pedido"""))
def rekeyed_orders(s: Source):
    """Orders re-keyed to a calendar that numbers its days from 1001."""
    star = s.warehouse.star
    other = star["dim_tiempo"].withColumn("tiempo_sk", F.col("tiempo_sk") + 1000)
    orders = resolve_keys(s.warehouse.oltp["pedidos"], {"tiempo_sk": (star["dim_tiempo"], {"fecha_pedido": "fecha"})})
    return rekey(orders.select("pedido_id", "tiempo_sk"), {"tiempo_sk": key_map(star["dim_tiempo"], other, "tiempo_sk", ["fecha"])})


@query("j6_role_playing", with_views("rutas", """SELECT ruta_id, nombre_transitario, puerto_salida, puerto_llegada FROM rutas"""))
def role_playing_ports(s: Source):
    t = s.warehouse.oltp
    routes = star_plans.route_attributes(t["rutas_logisticas"], t["transitarios"], t["puertos"])
    return routes.select("ruta_id", "nombre_transitario", "puerto_salida", "puerto_llegada")


@query("w2_surrogate_keys", """SELECT CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS pedido_sk,
    o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders""")
def surrogate_keys(s: Source):
    """Dense keys over a whole order table without gathering it in one task."""
    from ..operators.keys import assign_sk

    orders = s.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("total"))
    return assign_sk(orders, "pedido_sk", [F.desc("total"), F.asc("o_orderkey")])
