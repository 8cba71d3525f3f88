"""Derivation jobs between OLTP tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..operators.joins import skew_join
from ..plans import derive
from ..plans.retail import FAMILY_PRICES, PART_PRICES
from .registry import Source, query
from .sql import pick, stepped, with_views

_ENTRY = "CAST(fecha_cosecha + 2 AS DATE)"
_LOTS = "SELECT l.*, 'LOT' || lpad(CAST(lote_id AS VARCHAR), 12, '0') AS codigo_lote FROM lotes l"


@query("t1_lots", with_views("lotes", f"""SELECT lote_id, lote_id AS cosecha_id, codigo_lote, kilos_lote,
    CAST(fecha_cosecha + 1 AS DATE) AS fecha_creacion_lote, estado_lote AS estado FROM ({_LOTS})"""))
def lots(s: Source):
    return s.warehouse.oltp["lotes_origen"]


@query("t2_warehouse_lots", with_views("lotes", f"""SELECT lote_id, codigo_lote, nombre_producto AS producto, kilos_lote AS kilos_totales,
    {_ENTRY} AS fecha_entrada_almacen FROM ({_LOTS})"""))
def warehouse_lots(s: Source):
    return s.warehouse.oltp["lotes"]


@query("t3_quality_controls", with_views("lotes", f"""SELECT lote_id AS control_id, lote_id, CAST(fecha_cosecha + 3 AS DATE) AS fecha_control,
    {pick(['Ana Lopez', 'Luis Garcia', 'Marta Ruiz', 'Pablo Gomez', 'Carmen Perez'], 'lote_id')} AS inspector, kilos_lote AS kilos_inspeccionados,
    CAST(ROUND(kilos_lote * (0.02 + (lote_id % 6) * 0.006), 2) AS DECIMAL(10,2)) AS kilos_rechazados,
    CAST(ROUND((0.02 + (lote_id % 6) * 0.006) * 100, 2) AS DECIMAL(5,2)) AS porcentaje_merma,
    CAST(60 + lote_id % 20 AS DECIMAL(5,2)) AS porcentaje_primera_categoria, CAST(20 + (lote_id + 3) % 15 AS DECIMAL(5,2)) AS porcentaje_segunda_categoria,
    CAST(ROUND(7 + (lote_id % 7) * 0.35, 2) AS DECIMAL(4,2)) AS puntuacion_calidad FROM lotes"""))
def quality_controls(s: Source):
    return s.warehouse.oltp["controles_calidad"]


_SHARES = {size: "list_extract([" + ", ".join(map(str, shares)) + "], CAST(lote_id % 4 + 1 AS INT))" for size, shares in derive.SIZE_SHARES.items()}
_SIZES = " UNION ALL ".join(
    f"SELECT (lote_id - 1) * 4 + {i} AS calibre_id, lote_id, '{size}' AS calibre, CAST(ROUND(kilos_lote * {share} * 0.01, 2) AS DECIMAL(10,2)) AS kilos_calibre, "
    f"CAST({share} AS DECIMAL(5,2)) AS porcentaje_sobre_total FROM lotes" for i, (size, share) in enumerate(_SHARES.items(), 1))


@query("t4_split", with_views("lotes", _SIZES))
def size_split(s: Source):
    return s.warehouse.oltp["calibres"]


@query("t5_certificates", with_views("lotes", f"""SELECT lote_id AS certificado_id, lote_id, tipo_certificado, {_ENTRY} AS fecha_emision,
    CAST(fecha_cosecha + 367 AS DATE) AS fecha_caducidad, {pick(['AENOR', 'CAAE', 'Bureau Veritas', 'SGS'], 'lote_id')} AS entidad_certificadora,
    'CERT-' || lpad(CAST(lote_id AS VARCHAR), greatest(6, length(CAST(lote_id AS VARCHAR)))::INT, '0') AS numero_certificado FROM lotes"""))
def certificates(s: Source):
    return s.warehouse.oltp["certificados"]


@query("t6_quality_incidents", with_views("lotes", f"""SELECT lote_id // 5 AS incidencia_id, lote_id, CAST(fecha_cosecha + 4 AS DATE) AS fecha_incidencia,
    {pick(derive.QUALITY_INCIDENTS, 'lote_id')} AS tipo_incidencia, 'Incidencia registrada sobre el lote ' || codigo_lote AS descripcion,
    CAST(4 + lote_id % 12 AS DECIMAL(10,2)) AS kilos_afectados, 'Reclasificacion, separacion y seguimiento de trazabilidad' AS accion_correctiva
    FROM ({_LOTS}) WHERE lote_id % 5 = 0"""))
def quality_incidents(s: Source):
    return s.warehouse.oltp["incidencias_calidad"]


_PRICE = "CASE familia_producto " + " ".join(f"WHEN '{f}' THEN {p}" for f, p in FAMILY_PRICES.items()) + " ELSE 2.10 END"
_UNIT = f"(CAST({_PRICE} AS DECIMAL(10,2)) + (d.pedido_id % 5) * 0.10)"


@query("t7_pricing", with_views("lotes", f"""SELECT d.pedido_id, d.lote_id, d.kilos AS kilos_solicitados, CAST(3 + p.cliente_id % 6 AS DECIMAL(5,2)) AS descuento_porcentaje,
    CAST({_UNIT} AS DECIMAL(10,2)) AS precio_unitario_kg, CAST(ROUND(d.kilos * {_UNIT}, 2) AS DECIMAL(12,2)) AS importe_bruto,
    CAST(ROUND(d.kilos * {_UNIT} * (100 - CAST(3 + p.cliente_id % 6 AS DECIMAL(5,2))) * 0.01, 2) AS DECIMAL(12,2)) AS importe_neto
    FROM detalle d JOIN pedidos p ON p.pedido_id = d.pedido_id JOIN lotes l ON l.lote_id = d.lote_id"""))
def pricing(s: Source):
    """Lines priced by family, order and contract discount.

    Discounts are found at order grain and families at lot grain, so the lines are joined twice.
    """
    t = s.warehouse.oltp
    contracts = t["contratos"].select("contrato_id", "descuento_general_porcentaje")
    discounts = skew_join(t["pedidos"].select("pedido_id", "contrato_id"), contracts, "contrato_id").select(
        "pedido_id", F.col("descuento_general_porcentaje").alias("descuento_porcentaje"))
    families = t["cosechas"].join(t["cultivos"], "cultivo_id").select(F.col("cosecha_id").alias("lote_id"), "familia_producto")
    hot = s.warehouse.hot_join_keys()
    lines = t["detalle_pedido"].select("pedido_id", "lote_id", "kilos_solicitados")
    lines = skew_join(lines, families, "lote_id", hot=hot["lote_id"])
    lines = skew_join(lines, discounts, "pedido_id", hot=hot["pedido_id"])
    priced = derive.price_lines(lines, derive.base_price("familia_producto", FAMILY_PRICES))
    return priced.select("pedido_id", "lote_id", "kilos_solicitados", "descuento_porcentaje", "precio_unitario_kg",
                         "importe_bruto", "importe_neto")


_LIST_PRICE = "CASE p_name " + " ".join(f"WHEN '{n}' THEN {p}" for n, p in PART_PRICES.items()) + " ELSE 2.10 END"


@query("t8_price_list", f"""SELECT p_partkey * 4 + i AS tarifa_id, p_name AS producto, p_brand AS variedad, talla AS calibre,
    CAST({_LIST_PRICE} + recargo AS DECIMAL(10,2)) AS precio_base_kg, DATE '1995-01-01' AS fecha_vigencia_inicio, DATE '2001-12-31' AS fecha_vigencia_fin
    FROM part, (VALUES (1, 'S', -0.10), (2, 'M', 0.00), (3, 'L', 0.10), (4, 'XL', 0.20)) t(i, talla, recargo)""")
def price_list(s: Source):
    return s.warehouse.oltp["tarifas"]


@query("t9_shipments", with_views("costes_envio", """SELECT pedido_id AS envio_id, pedido_id, ruta_id, ruta_id AS transitario_id, CAST(fecha_pedido + 1 AS DATE) AS fecha_envio,
    CAST(fecha_pedido + 1 + dias_estimados AS DATE) AS fecha_entrega_estimada, CAST(fecha_pedido + 1 + dias AS DATE) AS fecha_entrega_real,
    kilos_pedido AS kilos_totales, 'CONT-' || lpad(CAST(pedido_id AS VARCHAR), greatest(6, length(CAST(pedido_id AS VARCHAR)))::INT, '0') AS numero_contenedor,
    CAST(ROUND(kilos_pedido * coste_kg, 2) AS DECIMAL(18,2)) AS coste_envio_total, CAST(coste_kg AS DECIMAL(10,4)) AS coste_por_kg,
    CASE WHEN pedido_id % 7 = 0 THEN 'incidencia' WHEN pedido_id % 5 = 0 THEN 'aduana' ELSE 'entregado' END AS estado FROM costes_envio"""))
def shipments(s: Source):
    return s.warehouse.oltp["envios"]


@query("t10_customs", with_views("envios", """SELECT pedido_id AS aduana_id, pedido_id AS envio_id, pais_llegada AS pais_aduana, CAST(fecha_pedido + 2 AS DATE) AS fecha_entrada_aduana,
    CAST(fecha_pedido + 3 AS DATE) AS fecha_salida_aduana, CAST(15 + (pedido_id % 10) * 3 AS DECIMAL(12,2)) AS coste_aranceles,
    pedido_id % 6 <> 0 AS documentacion_completa FROM envios"""))
def customs(s: Source):
    return s.warehouse.oltp["aduanas"]


@query("t11_shipment_incidents", with_views("envios", f"""SELECT pedido_id // 4 AS incidencia_envio_id, pedido_id AS envio_id, CAST(fecha_pedido + 3 AS DATE) AS fecha_incidencia,
    {pick(derive.SHIPMENT_INCIDENTS, 'pedido_id')} AS tipo_incidencia, 'Incidencia registrada en el envio CONT-' || lpad(CAST(pedido_id AS VARCHAR), greatest(6, length(CAST(pedido_id AS VARCHAR)))::INT, '0') AS descripcion,
    CAST(20 + pedido_id % 30 AS DECIMAL(10,2)) AS coste_adicional, {pick(derive.RESPONSIBLE, 'pedido_id')} AS responsable FROM envios WHERE pedido_id % 4 = 0"""))
def shipment_incidents(s: Source):
    return s.warehouse.oltp["incidencias_envio"]


_INVOICES = """SELECT t.pedido_id AS factura_id, t.pedido_id, CAST(fecha_pedido + 1 AS DATE) AS fecha_emision, CAST(fecha_pedido + 31 AS DATE) AS fecha_vencimiento,
    bruto_pedido AS importe_bruto, CAST(bruto_pedido - neto_pedido AS DECIMAL(18,2)) AS descuento, CAST(ROUND(neto_pedido * 0.04, 2) AS DECIMAL(18,2)) AS impuestos,
    CAST(ROUND(neto_pedido * 1.04, 2) AS DECIMAL(18,2)) AS importe_total, CASE WHEN t.pedido_id % 5 = 0 THEN 'USD' ELSE 'EUR' END AS divisa,
    CASE WHEN t.pedido_id % 6 = 0 THEN 'pagada' ELSE 'pendiente' END AS estado FROM totales t JOIN pedidos p ON p.pedido_id = t.pedido_id"""


@query("t12_invoices", with_views("totales", _INVOICES))
def invoices(s: Source):
    return s.warehouse.oltp["facturas"]


@query("t13_payments", with_views("totales", f"""SELECT factura_id AS cobro_id, factura_id, CAST(fecha_emision + 15 AS DATE) AS fecha_cobro, importe_total AS importe_cobrado,
    {pick(derive.PAYMENT_METHODS, 'factura_id')} AS metodo_pago, {pick(derive.BANKS, 'factura_id')} AS banco,
    'Cobro registrado sobre factura ' || CAST(factura_id AS VARCHAR) AS observaciones FROM ({_INVOICES})"""))
def payments(s: Source):
    return s.warehouse.oltp["cobros"]


_PARTS = {name: stepped(base, "lote_id", modulus, step) for name, (base, modulus, step) in derive.LOT_COSTS.items()}


@query("t14_unit_cost", with_views("lotes", f"""SELECT lote_id AS coste_lote_id, lote_id, {', '.join(f'{p} AS {n}' for n, p in _PARTS.items())},
    CAST(total_lote AS DECIMAL(12,2)) AS coste_total_produccion, producto_kg AS coste_por_kg FROM lotes"""))
def unit_cost(s: Source):
    return s.warehouse.oltp["costes_lote"]


_SHIP_PARTS = {name: stepped(base, "pedido_id", modulus, step) for name, (base, modulus, step) in derive.SHIPPING_COSTS.items()}


@query("t15_shipping_cost", with_views("costes_envio", f"""SELECT pedido_id AS coste_logistico_id, pedido_id AS envio_id, CAST(ROUND(transporte, 2) AS DECIMAL(18,2)) AS coste_transporte,
    {', '.join(f'{p} AS {n}' for n, p in _SHIP_PARTS.items())}, CAST(ROUND(total_log, 2) AS DECIMAL(18,2)) AS coste_total_logistica, logistico_kg AS coste_por_kg FROM costes_envio"""))
def shipping_cost(s: Source):
    return s.warehouse.oltp["costes_logisticos"]


@query("t16_exchange_rates", """SELECT g AS tipo_cambio_id, CASE WHEN g % 2 = 0 THEN 'EUR' ELSE 'USD' END AS divisa_origen, CASE WHEN g % 2 = 0 THEN 'USD' ELSE 'EUR' END AS divisa_destino,
    fecha, CAST(ROUND(1.05 + g * 0.002, 4) AS DECIMAL(10,4)) AS tasa_cambio
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha, date_diff('day', DATE '1994-12-31', CAST(o_orderdate AS DATE)) AS g FROM orders)""")
def exchange_rates(s: Source):
    return s.warehouse.oltp["tipos_cambio"]


@query("t17_masters", with_views("clientes", """SELECT c.cliente_id AS contrato_id, cliente_id, DATE '1995-01-01' AS fecha_inicio, DATE '2001-12-31' AS fecha_fin,
    list_extract(['30 dias transferencia', '45 dias transferencia', 'Contado'], CAST(cliente_id % 3 + 1 AS INT)) AS condiciones_pago,
    CAST(3 + cliente_id % 6 AS DECIMAL(5,2)) AS descuento_general_porcentaje, CAST(500 + (cliente_id % 10) * 150 AS DECIMAL(10,2)) AS volumen_minimo_kg,
    CAST(1.80 + (cliente_id % 7) * 0.20 AS DECIMAL(10,2)) AS precio_base_kg FROM clientes c"""))
def contracts(s: Source):
    """Contracts generated from customers; the other masters are read, not generated."""
    return s.warehouse.oltp["contratos"]
