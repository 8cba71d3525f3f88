"""Derivation jobs: each OLTP table that follows from others.

Identifiers of derived rows are computed from the parent's identifier, so none of
these jobs needs a global numbering.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import add_days
from ..functions.numbers import dec, money, rounded, safe_ratio
from ..functions.text import cycle, map_values, zero_pad
from ..operators.joins import lean_join, sized_join, skew_join
from ..operators.reshape import expand_list, unpivot_exprs
from ..schemas import SALES

# Rule parameters that decide the derived rows.
LOT_STATES = ["enviado", "en_almacen", "en_campo"]
INSPECTORS = ["Ana Lopez", "Luis Garcia", "Marta Ruiz", "Pablo Gomez", "Carmen Perez"]
SIZE_SHARES = {"S": [45, 20, 15, 10], "M": [25, 45, 25, 20], "L": [20, 25, 45, 25], "XL": [10, 10, 15, 45]}
CERTIFICATE_KINDS = ["GlobalGAP", "ECO", "ISO22000", "GRASP"]
CERTIFIERS = ["AENOR", "CAAE", "Bureau Veritas", "SGS"]
QUALITY_INCIDENTS = ["plagas", "defectos", "contaminacion", "rechazo_cliente"]
QUALITY_ACTION = "Reclasificacion, separacion y seguimiento de trazabilidad"
SHIPMENT_INCIDENTS = ["retraso", "merma", "rechazo_aduana", "danos_transporte"]
RESPONSIBLE = ["transitario", "aduana", "almacen"]
PAYMENT_METHODS = ["transferencia", "credito", "contado"]
BANKS = ["Santander", "CaixaBank", "BBVA", "Sabadell"]
BASE_PRICES = {
    "Tomate": "2.20", "Pimiento": "2.50", "Pepino": "1.95", "Aguacate": "3.80", "Fresa": "3.20",
    "Naranja": "1.85", "Limon": "2.05", "Calabacin": "1.90", "Frambuesa": "4.10", "Arandano": "4.40",
}
DEFAULT_BASE_PRICE = "2.10"
SIZE_SURCHARGE = {"S": "-0.10", "M": "0.00", "L": "0.10", "XL": "0.20"}
#: component -> (base, modulus, step): cost = base + (id mod modulus) * step
LOT_COSTS = {
    "coste_semillas": ("40", 12, "3"), "coste_agua": ("35", 10, "2.5"), "coste_fertilizantes": ("30", 9, "2.8"),
    "coste_mano_obra": ("80", 15, "4"), "coste_maquinaria": ("45", 11, "2.2"),
}
SHIPPING_COSTS = {
    "coste_aduana": ("10", 8, "2"), "coste_almacenaje": ("8", 6, "1.5"), "coste_seguro": ("5", 5, "1.2"),
}
TRANSPORT_SHARE = "0.70"
TAX_RATE = "0.04"


def num(text: str) -> Column:
    """Exact decimal literal."""
    return F.lit(Decimal(text))


def stepped(identifier: Column, base: str, modulus: int, step: str) -> Column:
    return dec(num(base) + (identifier % modulus) * num(step), 12, 2)


def base_price(product: Column | str, prices: Mapping[str, str] = BASE_PRICES) -> Column:
    prices = {name: Decimal(p) for name, p in prices.items()}
    return map_values(product, prices, default=num(DEFAULT_BASE_PRICE))


def lots(harvests: DataFrame) -> DataFrame:
    """lotes_origen: one lot per harvest, net of the loss in the field."""
    loss = dec(F.col("merma_campo_porcentaje"), 5, 2) / F.lit(100)
    return harvests.select(
        F.col("cosecha_id").alias("lote_id"),
        "cosecha_id",
        F.concat(F.lit("LOT"), zero_pad("cosecha_id", 5)).alias("codigo_lote"),
        rounded(F.col("kilos_cosechados") * (1 - loss), 2, 10).alias("kilos_lote"),
        add_days("fecha_cosecha", 1).alias("fecha_creacion_lote"),
        cycle(LOT_STATES, F.col("cosecha_id")).alias("estado"),
    )


def warehouse_lots(lots: DataFrame, harvests: DataFrame, crops: DataFrame) -> DataFrame:
    """lotes: lots as the warehouse receives them, with their product name."""
    products = lean_join(harvests.select("cosecha_id", "cultivo_id"), crops.select("cultivo_id", F.col("nombre_producto").alias("producto")), "cultivo_id")
    return lean_join(lots, products.drop("cultivo_id"), "cosecha_id").select(
        "lote_id", "codigo_lote", "producto",
        F.col("kilos_lote").alias("kilos_totales"),
        add_days("fecha_creacion_lote", 1).alias("fecha_entrada_almacen"),
    )


def quality_controls(lots: DataFrame) -> DataFrame:
    """controles_calidad: one inspection per warehouse lot."""
    lot = F.col("lote_id")
    rejected = num("0.02") + (lot % 6) * num("0.006")
    return lots.select(
        lot.alias("control_id"), "lote_id",
        add_days("fecha_entrada_almacen", 1).alias("fecha_control"),
        cycle(INSPECTORS, lot).alias("inspector"),
        F.col("kilos_totales").alias("kilos_inspeccionados"),
        rounded(F.col("kilos_totales") * rejected, 2, 10).alias("kilos_rechazados"),
        rounded(rejected * 100, 2, 5).alias("porcentaje_merma"),
        dec(60 + lot % 20, 5, 2).alias("porcentaje_primera_categoria"),
        dec(20 + (lot + 3) % 15, 5, 2).alias("porcentaje_segunda_categoria"),
        rounded(7 + (lot % 7) * num("0.35"), 2, 4).alias("puntuacion_calidad"),
    )


def size_split(lots: DataFrame) -> DataFrame:
    """calibres: the lot's kilos split over the sizes, one row per size."""
    lot = F.col("lote_id")
    sizes = list(SIZE_SHARES)
    shares = [(size, dec(cycle(SIZE_SHARES[size], lot), 5, 2)) for size in sizes]
    split = unpivot_exprs(lots, shares, "calibre", "porcentaje_sobre_total", keep=["lote_id", "kilos_totales"])
    position = F.array_position(F.array(*[F.lit(s) for s in sizes]), F.col("calibre"))
    return split.select(
        ((lot - 1) * len(sizes) + position).alias("calibre_id"),
        "lote_id", "calibre",
        rounded(F.col("kilos_totales") * F.col("porcentaje_sobre_total") / 100, 2, 10).alias("kilos_calibre"),
        "porcentaje_sobre_total",
    )


def certificates(lots: DataFrame, valid_days: int = 365) -> DataFrame:
    """certificados: one certificate per warehouse lot."""
    lot = F.col("lote_id")
    return lots.select(
        lot.alias("certificado_id"), "lote_id",
        cycle(CERTIFICATE_KINDS, lot).alias("tipo_certificado"),
        F.col("fecha_entrada_almacen").alias("fecha_emision"),
        add_days("fecha_entrada_almacen", valid_days).alias("fecha_caducidad"),
        cycle(CERTIFIERS, lot).alias("entidad_certificadora"),
        F.concat(F.lit("CERT-"), zero_pad("lote_id", 6)).alias("numero_certificado"),
    )


def quality_incidents(lots: DataFrame, every: int = 5) -> DataFrame:
    """incidencias_calidad: an incident on each ``every``-th lot."""
    lot = F.col("lote_id")
    return lots.filter(lot % every == 0).select(
        F.expr(f"lote_id div {every}").alias("incidencia_id"), "lote_id",
        add_days("fecha_entrada_almacen", 2).alias("fecha_incidencia"),
        cycle(QUALITY_INCIDENTS, lot).alias("tipo_incidencia"),
        F.concat(F.lit("Incidencia registrada sobre el lote "), F.col("codigo_lote")).alias("descripcion"),
        dec(4 + lot % 12, 10, 2).alias("kilos_afectados"),
        F.lit(QUALITY_ACTION).alias("accion_correctiva"),
    )


def price_lines(lines: DataFrame, price: Column) -> DataFrame:
    """Price order lines: base price plus a step per order, gross, and net of the contract discount."""
    unit = price + (F.col("pedido_id") % 5) * num("0.10")
    gross = F.col("kilos_solicitados") * unit
    return lines.withColumns({
        "precio_unitario_kg": rounded(unit, 2, 10),
        "importe_bruto": rounded(gross, 2),
        "importe_neto": rounded(gross * (1 - dec(F.col("descuento_porcentaje"), 5, 2) / F.lit(100)), 2),
    })


def price_list(crops: DataFrame, start: str, end: str, prices: Mapping[str, str] = BASE_PRICES) -> DataFrame:
    """tarifas: one price per crop and size over a validity range."""
    sizes = list(SIZE_SURCHARGE)
    position = F.array_position(F.array(*[F.lit(s) for s in sizes]), F.col("calibre"))
    surcharge = map_values("calibre", {s: Decimal(v) for s, v in SIZE_SURCHARGE.items()}, default=num("0.00"))
    return expand_list(crops, "calibre", sizes).select(
        ((F.col("cultivo_id") - 1) * len(sizes) + position).alias("tarifa_id"),
        F.col("nombre_producto").alias("producto"), "variedad", "calibre",
        rounded(base_price("nombre_producto", prices) + surcharge, 2, 10).alias("precio_base_kg"),
        F.to_date(F.lit(start)).alias("fecha_vigencia_inicio"),
        F.to_date(F.lit(end)).alias("fecha_vigencia_fin"),
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Kilos and amounts per order; combined before the shuffle, so a huge order is no hot spot."""
    sums = {"kilos": "kilos_solicitados", "bruto": "importe_bruto", "neto": "importe_neto"}
    return lines.groupBy("pedido_id").agg(*[dec(F.sum(c), 18, 2).alias(name) for name, c in sums.items()])


def shipment_state(orders: Column) -> Column:
    return F.when(orders % 7 == 0, "incidencia").when(orders % 5 == 0, "aduana").otherwise("entregado")


def shipments(orders: DataFrame, totals: DataFrame, routes: DataFrame, route_of: Column, state: Column | None = None) -> DataFrame:
    """envios: one shipment per order over the route whose key ``route_of`` computes from the order."""
    order, out = F.col("pedido_id"), add_days("fecha_pedido", 1)
    planned = add_days(out, F.col("duracion_estimada_dias"))
    keyed = orders.select("pedido_id", "fecha_pedido", route_of.cast("bigint").alias("ruta_id"))
    legs = routes.select("ruta_id", "transitario_id", "duracion_estimada_dias", "coste_base_kg")
    return sized_join(sized_join(keyed, totals.select("pedido_id", "kilos"), "pedido_id"), legs, "ruta_id").select(
        order.alias("envio_id"), "pedido_id", "ruta_id", "transitario_id",
        out.alias("fecha_envio"),
        planned.alias("fecha_entrega_estimada"),
        add_days(planned, order % 2).alias("fecha_entrega_real"),
        F.col("kilos").alias("kilos_totales"),
        F.concat(F.lit("CONT-"), zero_pad("pedido_id", 6)).alias("numero_contenedor"),
        rounded(F.col("kilos") * F.col("coste_base_kg"), 2, 18).alias("coste_envio_total"),
        dec("coste_base_kg", 10, 4).alias("coste_por_kg"),
        (state if state is not None else shipment_state(order)).alias("estado"),
    )


def customs(shipments: DataFrame, routes: DataFrame, ports: DataFrame) -> DataFrame:
    """aduanas: customs of the country the shipment arrives in."""
    arrival = routes.join(ports, routes.puerto_llegada_id == ports.puerto_id).select(
        "ruta_id", F.col("pais").alias("pais_aduana"))
    shipment = F.col("envio_id")
    return shipments.join(arrival, "ruta_id").select(
        shipment.alias("aduana_id"), "envio_id", "pais_aduana",
        add_days("fecha_envio", 1).alias("fecha_entrada_aduana"),
        add_days("fecha_envio", 2).alias("fecha_salida_aduana"),
        money(15 + (shipment % 10) * 3).alias("coste_aranceles"),
        (shipment % 6 != 0).alias("documentacion_completa"),
    )


def shipment_incidents(shipments: DataFrame, every: int = 4) -> DataFrame:
    """incidencias_envio: an incident on each ``every``-th shipment."""
    shipment = F.col("envio_id")
    return shipments.filter(shipment % every == 0).select(
        F.expr(f"envio_id div {every}").alias("incidencia_envio_id"), "envio_id",
        add_days("fecha_envio", 2).alias("fecha_incidencia"),
        cycle(SHIPMENT_INCIDENTS, shipment).alias("tipo_incidencia"),
        F.concat(F.lit("Incidencia registrada en el envio "), F.col("numero_contenedor")).alias("descripcion"),
        dec(20 + shipment % 30, 10, 2).alias("coste_adicional"),
        cycle(RESPONSIBLE, shipment).alias("responsable"),
    )


def invoices(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """facturas: one invoice per order with discount, tax and total."""
    order, net = F.col("pedido_id"), F.col("neto")
    return sized_join(totals, orders.select("pedido_id", "fecha_pedido"), "pedido_id").select(
        order.alias("factura_id"), "pedido_id",
        add_days("fecha_pedido", 1).alias("fecha_emision"),
        add_days("fecha_pedido", 31).alias("fecha_vencimiento"),
        F.col("bruto").alias("importe_bruto"),
        rounded(F.col("bruto") - net, 2, 18).alias("descuento"),
        rounded(net * num(TAX_RATE), 2, 18).alias("impuestos"),
        rounded(net * (1 + num(TAX_RATE)), 2, 18).alias("importe_total"),
        F.when(order % 5 == 0, "USD").otherwise("EUR").alias("divisa"),
        F.when(order % 6 == 0, "pagada").otherwise("pendiente").alias("estado"),
    )


def payments(invoices: DataFrame, days: int = 15) -> DataFrame:
    """cobros: each invoice paid in full ``days`` after it was issued."""
    invoice = F.col("factura_id")
    return invoices.select(
        invoice.alias("cobro_id"), "factura_id",
        add_days("fecha_emision", days).alias("fecha_cobro"),
        F.col("importe_total").alias("importe_cobrado"),
        cycle(PAYMENT_METHODS, invoice).alias("metodo_pago"),
        cycle(BANKS, invoice).alias("banco"),
        F.concat(F.lit("Cobro registrado sobre factura "), invoice.cast("string")).alias("observaciones"),
    )


def _total(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def lot_costs(lots: DataFrame) -> DataFrame:
    """costes_lote: cost components of a lot, their total and the cost per kilo."""
    parts = {name: stepped(F.col("lote_id"), *rule) for name, rule in LOT_COSTS.items()}
    total = money(_total(list(parts.values())))
    return lots.select(
        F.col("lote_id").alias("coste_lote_id"), "lote_id",
        *[part.alias(name) for name, part in parts.items()],
        total.alias("coste_total_produccion"),
        rounded(safe_ratio(total, "kilos_lote"), 4, 10).alias("coste_por_kg"),
    )


def shipping_costs(shipments: DataFrame) -> DataFrame:
    """costes_logisticos: transport share plus fixed components, total and cost per kilo."""
    transport = F.col("kilos_totales") * F.col("coste_por_kg") * num(TRANSPORT_SHARE)
    parts = {name: stepped(F.col("envio_id"), *rule) for name, rule in SHIPPING_COSTS.items()}
    # Transport enters the total unrounded; only the stored column is rounded.
    total = transport + _total(list(parts.values()))
    return shipments.select(
        F.col("envio_id").alias("coste_logistico_id"), "envio_id",
        rounded(transport, 2, 18).alias("coste_transporte"),
        *[part.alias(name) for name, part in parts.items()],
        rounded(total, 2, 18).alias("coste_total_logistica"),
        rounded(safe_ratio(total, "kilos_totales"), 4, 10).alias("coste_por_kg"),
    )


def exchange_rates(days: DataFrame) -> DataFrame:
    """tipos_cambio: a rate per day; ``days`` holds (g, fecha), g counting from 1."""
    g = F.col("g")
    return days.select(
        g.cast("bigint").alias("tipo_cambio_id"),
        cycle(["EUR", "USD"], g).alias("divisa_origen"),
        cycle(["USD", "EUR"], g).alias("divisa_destino"),
        "fecha",
        rounded(num("1.05") + g * num("0.002"), 4, 10).alias("tasa_cambio"),
    )


def served_lines(t: Mapping[str, DataFrame]) -> DataFrame:
    """detalle_pedido as declared: the order lines with the product and variety of their lot.

    The models join lines and lots themselves, so only readers of the served table pay for this join.
    """
    declared = SALES["detalle_pedido"].names
    if set(declared) <= set(t["detalle_pedido"].columns):
        return t["detalle_pedido"].select(*declared)
    grown = sized_join(t["lotes_origen"].select("lote_id", "cosecha_id"), t["cosechas"].select("cosecha_id", "cultivo_id"), "cosecha_id")
    names = sized_join(grown, t["cultivos"].select("cultivo_id", F.col("nombre_producto").alias("producto"), "variedad"), "cultivo_id")
    return skew_join(t["detalle_pedido"], names.select("lote_id", "producto", "variedad"), "lote_id").select(*declared)
