"""Star model: eight dimensions and the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_parts, days_between
from ..functions.numbers import dec, flag, money, rounded, safe_ratio
from ..operators.dedup import top1_per_group
from ..operators.joins import sized_join, skew_join, skewed
from ..operators.keys import assign_sk, number_dimension
from ..operators.lookup import resolve_keys
from ..operators.reshape import select_values
from ..session import written

Tables = Mapping[str, DataFrame]


def list_band(value: Column | str, bands: Mapping[str, Sequence[str]], otherwise: str) -> Column:
    """Label of the first list that holds the value."""
    value = F.col(value) if isinstance(value, str) else value
    label = F.when(F.lit(False), F.lit(otherwise))
    for name, members in bands.items():
        label = label.when(value.isin(*members), F.lit(name))
    return label.otherwise(F.lit(otherwise))


@dataclass(frozen=True)
class Catalog:
    """Lists that band countries and products. The defaults are fixed values."""

    south: tuple[str, ...] = ("Espana", "Portugal", "Italia")
    centre: tuple[str, ...] = ("Francia", "Alemania", "Paises Bajos")
    punnet: tuple[str, ...] = ("Fresa", "Frambuesa", "Arandano")
    boxed: tuple[str, ...] = ("Aguacate", "Naranja", "Limon")
    bulk: tuple[str, ...] = ("Tomate", "Pimiento", "Pepino", "Calabacin")


def calendar_rows(dates: DataFrame, column: str = "fecha_pedido") -> DataFrame:
    """Calendar attributes of the distinct dates, without a key."""
    days = dates.select(F.col(column).alias("fecha")).distinct()
    return days.select("fecha", *[c.alias(n) for n, c in calendar_parts("fecha").items()])


def calendar_dim(orders: DataFrame) -> DataFrame:
    # Days of the calendar: their number is bounded whatever the data volume.
    return assign_sk(calendar_rows(orders), "tiempo_sk", ["fecha"], bounded=True)


def campaign_dim(campaigns: DataFrame) -> DataFrame:
    columns = ["campania_id", "nombre_campania", "fecha_inicio", "fecha_fin", "temporada", "anio_agricola",
               "observaciones_climaticas"]
    # One campaign per year.
    return number_dimension(select_values(campaigns, columns), "campania_sk", ["campania_id"])


def customer_dim(customers: DataFrame) -> DataFrame:
    names = {"cliente_id": "cliente_id", "nombre_cliente": "nombre_cliente", "tipo_cliente": "tipo_cliente",
             "canal": "canal", "segmento": "segmento", "pais": "pais_cliente", "ciudad": "ciudad_cliente",
             "email": "email", "telefono": "telefono"}
    return number_dimension(select_values(customers, names), "cliente_sk", ["cliente_id"])


def geography_dim(customers: DataFrame, catalog: Catalog = Catalog()) -> DataFrame:
    europe = catalog.south + catalog.centre
    places = customers.select("ciudad", "pais").distinct().select(
        "ciudad",
        F.col("ciudad").alias("provincia"),
        list_band("pais", {"Europa Occidental": europe}, "Otras regiones").alias("region"),
        "pais",
        list_band("pais", {"Sur de Europa": catalog.south, "Centro de Europa": catalog.centre},
                  "Mercado Internacional").alias("zona_comercial"),
        list_band("pais", {"Europa": europe}, "Otro").alias("continente"),
    )
    return number_dimension(places, "geografia_sk", ["pais", "ciudad"])


def farm_dim(plots: DataFrame, farms: DataFrame) -> DataFrame:
    own = plots.select("parcela_id", "finca_id", "nombre_parcela", "superficie_hectareas")
    joined = sized_join(own, farms.select("finca_id", "nombre_finca", "municipio", "provincia", "zona_agricola", "tipo_suelo", "sistema_riego"), "finca_id").select(
        "finca_id", "nombre_finca", F.col("nombre_parcela").alias("parcela"), "superficie_hectareas", "municipio",
        "provincia", "zona_agricola", "tipo_suelo", "sistema_riego", "parcela_id")
    return number_dimension(joined, "finca_sk", ["finca_id", "parcela_id"]).drop("parcela_id")


def product_rows(crops: DataFrame, catalog: Catalog = Catalog()) -> DataFrame:
    product = F.col("nombre_producto")
    weight = F.when(product.isin(*catalog.punnet), F.lit("0.50")).when(product.isin(*catalog.boxed), F.lit("4.00"))
    return crops.select(
        "cultivo_id", "nombre_producto", "variedad", "familia_producto",
        list_band(product, {"Tarrina": catalog.punnet}, "Caja").alias("tipo_envase"),
        list_band(product, {"Granel": catalog.bulk, "Caja 4kg": catalog.boxed}, "Tarrina 500g").alias("formato_comercial"),
        dec(weight.otherwise(F.lit("5.00")), 10, 2).alias("peso_unidad"),
    )


def product_dim(crops: DataFrame, catalog: Catalog = Catalog()) -> DataFrame:
    return number_dimension(product_rows(crops, catalog), "producto_sk", ["cultivo_id"])


def dominant_size(sizes: DataFrame) -> DataFrame:
    """The size with most kilos of each lot; a tie goes to the first in the alphabet."""
    top = top1_per_group(sizes, ["lote_id"], [F.desc("kilos_calibre"), F.asc("calibre")])
    return top.select("lote_id", "calibre")


def commercial_category(first_class: Column | str) -> Column:
    first_class = F.col(first_class) if isinstance(first_class, str) else first_class
    return F.when(first_class >= 70, "Primera").otherwise("Segunda")


def quality_rows(lots: DataFrame, controls: DataFrame, sizes: DataFrame, certificates: DataFrame) -> DataFrame:
    certificate = F.col("tipo_certificado")
    rows = lots.select("lote_id", F.col("estado").alias("estado_lote"))
    rows = sized_join(rows, controls.select("lote_id", "porcentaje_primera_categoria"), "lote_id")
    rows = sized_join(rows, dominant_size(sizes), "lote_id")
    rows = sized_join(rows, certificates.select("lote_id", "tipo_certificado"), "lote_id")
    return rows.select("lote_id", commercial_category("porcentaje_primera_categoria").alias("categoria_comercial"),
                       "calibre", "tipo_certificado", "estado_lote",
                       flag(certificate == "ECO").alias("tiene_certificacion_eco"),
                       flag(certificate == "GlobalGAP").alias("tiene_certificacion_global_gap"))


def quality_dim(lots: DataFrame, controls: DataFrame, sizes: DataFrame, certificates: DataFrame) -> DataFrame:
    return number_dimension(quality_rows(lots, controls, sizes, certificates), "calidad_sk", ["lote_id"])


def route_attributes(routes: DataFrame, forwarders: DataFrame, ports: DataFrame) -> DataFrame:
    """Routes with forwarder and both ports; the port table plays two roles."""
    departure = ports.select(F.col("puerto_id").alias("puerto_salida_id"), F.col("nombre_puerto").alias("puerto_salida"))
    arrival = ports.select(F.col("puerto_id").alias("puerto_llegada_id"), F.col("nombre_puerto").alias("puerto_llegada"))
    own = routes.select("ruta_id", "transitario_id", "puerto_salida_id", "puerto_llegada_id", "tipo_transporte", "duracion_estimada_dias")
    legs = sized_join(own, forwarders.select("transitario_id", "nombre_transitario"), "transitario_id")
    return legs.join(departure, "puerto_salida_id").join(arrival, "puerto_llegada_id")


def logistics_dim(routes: DataFrame, forwarders: DataFrame, ports: DataFrame) -> DataFrame:
    rows = route_attributes(routes, forwarders, ports).select(
        "ruta_id", "nombre_transitario", "puerto_salida", "puerto_llegada", "tipo_transporte",
        F.concat("puerto_salida", F.lit(" -> "), "puerto_llegada").alias("ruta_logistica"),
        "duracion_estimada_dias")
    return number_dimension(rows, "logistica_sk", ["ruta_id"])


def dimensions(t: Tables, catalog: Catalog = Catalog()) -> dict:
    """Builders of the eight dimensions over OLTP tables ``t``."""
    return {
        "dim_tiempo": lambda: calendar_dim(t["pedidos"]),
        "dim_campania": lambda: campaign_dim(t["campanias"]),
        "dim_cliente": lambda: customer_dim(t["clientes"]),
        "dim_geografia": lambda: geography_dim(t["clientes"], catalog),
        "dim_finca": lambda: farm_dim(t["parcelas"], t["fincas"]),
        "dim_producto": lambda: product_dim(t["cultivos"], catalog),
        "dim_calidad": lambda: quality_dim(
            t["lotes_origen"], t["controles_calidad"], t["calibres"], t["certificados"]),
        "dim_logistica": lambda: logistics_dim(t["rutas_logisticas"], t["transitarios"], t["puertos"]),
    }


def order_keys(t: Tables, dims: Tables) -> DataFrame:
    """Everything the fact takes from an order, at order grain: four keys, logistic cost, delivery days."""
    places = t["clientes"].select("cliente_id", "pais", "ciudad")
    customers = resolve_keys(places, {
        "geografia_sk": (dims["dim_geografia"], {"pais": "pais", "ciudad": "ciudad"}),
        "cliente_sk": (dims["dim_cliente"], {"cliente_id": "cliente_id"}),
    }).select("cliente_id", "cliente_sk", "geografia_sk")
    customers = written(customers, "customer-keys")
    shipped = t["envios"].select(
        "pedido_id", "envio_id", "ruta_id", days_between("fecha_envio", "fecha_entrega_real").alias("tiempo_entrega_dias"))
    cost = t["costes_logisticos"].select("envio_id", F.col("coste_por_kg").alias("logistico_kg"))
    orders = sized_join(sized_join(t["pedidos"].select("pedido_id", "cliente_id", "fecha_pedido"), shipped, "pedido_id"), cost, "envio_id")
    orders = skew_join(orders, customers, "cliente_id", hot=skewed(t["pedidos"], customers, ["cliente_id"]))
    resolved = resolve_keys(orders, {
        "tiempo_sk": (dims["dim_tiempo"], {"fecha_pedido": "fecha"}),
        "logistica_sk": (dims["dim_logistica"], {"ruta_id": "ruta_id"}),
    })
    return resolved.select("pedido_id", "tiempo_sk", "cliente_sk", "geografia_sk", "logistica_sk",
                           "tiempo_entrega_dias", "logistico_kg", F.year("fecha_pedido").alias("anio_pedido"))


def lot_keys(t: Tables, dims: Tables) -> DataFrame:
    """Everything the fact takes from a lot, at lot grain: four keys and the production cost."""
    harvests = t["cosechas"].select("cosecha_id", "parcela_id", "cultivo_id", "campania_id")
    cost = t["costes_lote"].select("lote_id", F.col("coste_por_kg").alias("producto_kg"))
    lots = sized_join(t["lotes_origen"].select("lote_id", "cosecha_id"), cost, "lote_id")
    lots = sized_join(lots, harvests, "cosecha_id")
    lots = sized_join(lots, t["parcelas"].select("parcela_id", "finca_id", "nombre_parcela"), "parcela_id")
    lots = written(lots, "lots")  # hot keys of large dimensions are looked for in it
    resolved = resolve_keys(lots, {
        "producto_sk": (dims["dim_producto"], {"cultivo_id": "cultivo_id"}),
        "finca_sk": (dims["dim_finca"], {"finca_id": "finca_id", "nombre_parcela": "parcela"}),
        "calidad_sk": (dims["dim_calidad"], {"lote_id": "lote_id"}),
        "campania_sk": (dims["dim_campania"], {"campania_id": "campania_id"}),
    })
    return resolved.select("lote_id", "producto_sk", "finca_sk", "calidad_sk", "campania_sk", "producto_kg")


KEYS = ["tiempo_sk", "producto_sk", "cliente_sk", "geografia_sk", "finca_sk", "calidad_sk", "logistica_sk",
        "campania_sk"]


def fact_measures(lines: DataFrame, further: Sequence[str] = ()) -> DataFrame:
    """The eleven measures of an order line that knows its unit costs, beside its keys and ``further`` columns."""
    kilos, gross, net = F.col("kilos_solicitados"), F.col("importe_bruto"), F.col("importe_neto")
    product, logistic = kilos * F.col("producto_kg"), kilos * F.col("logistico_kg")
    return lines.select(
        "detalle_id", "pedido_id", *KEYS,
        dec(kilos, 12, 2).alias("kilos_vendidos"),
        F.col("cajas_solicitadas").alias("cajas_vendidas"),
        gross.alias("importe_bruto"),
        rounded(gross - net, 2).alias("descuento"),
        net.alias("importe_neto"),
        rounded(product, 2).alias("coste_producto"),
        rounded(logistic, 2).alias("coste_logistico"),
        rounded(product + logistic, 2).alias("coste_total"),
        rounded(net - (product + logistic), 2).alias("margen"),
        rounded(safe_ratio(net, kilos), 4).alias("precio_medio_kg"),
        "tiempo_entrega_dias",
        *further,
        "anio_pedido",
    )


def star_fact(t: Tables, dims: Tables, of_products: DataFrame | None = None) -> DataFrame:
    """One row per order line, with the further columns that ``of_products`` has of the product's key.

    Keys are resolved at order and at lot grain first, so the line table, the
    only large one, is joined twice instead of once per dimension. Both sides are
    written once: their true size then decides the join strategy.
    """
    lines = t["detalle_pedido"].select(
        "detalle_id", "pedido_id", "lote_id", "kilos_solicitados", "cajas_solicitadas",
        money("importe_bruto").alias("importe_bruto"), money("importe_neto").alias("importe_neto"))
    orders = written(order_keys(t, dims), "order-keys")
    lots = lot_keys(t, dims)
    further = [] if of_products is None else [c for c in of_products.columns if c != "producto_sk"]
    if further:
        lots = lots.join(of_products, "producto_sk", "left")
    lots = written(lots, "lot-keys")
    hot_lots, hot_orders = skewed(lines, lots, ["lote_id"]), skewed(lines, orders, ["pedido_id"])
    with_lots = skew_join(lines, lots, "lote_id", hot=hot_lots)
    return fact_measures(skew_join(with_lots, orders, "pedido_id", hot=hot_orders), further)
