"""The reference-size warehouse: master data generated from integer series, the rest derived."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.dates import add_days
from starfold.functions.numbers import dec
from starfold.functions.text import cycle, zero_pad
from starfold.plans import derive
from starfold.plans.derive import num
from starfold.plans.retail import contract_rows
from starfold.sources import series

# Fixed values of the generated masters, each list indexed by the series number modulo its length.
FARM_TOWNS = ["Motril", "El Ejido", "Roquetas de Mar", "Cartaya", "Lepe", "Velez-Malaga"]
FARM_PROVINCES = ["Granada", "Almeria", "Almeria", "Huelva", "Huelva", "Malaga"]
CROPS = ["Tomate", "Tomate", "Pimiento", "Pimiento", "Pepino", "Aguacate", "Fresa", "Naranja", "Limon", "Calabacin",
         "Frambuesa", "Arandano"]
FAMILIES = ["Hortalizas", "Hortalizas", "Hortalizas", "Hortalizas", "Hortalizas", "Frutas", "Frutos rojos",
            "Citricos", "Citricos", "Hortalizas", "Frutos rojos", "Frutos rojos"]
VARIETIES = ["Cherry", "Rama", "Rojo", "Amarillo", "Almeria", "Hass", "Primoris", "Navelina", "Verna", "Verde",
             "Adelita", "Legacy"]
COUNTRIES = ["Espana", "Francia", "Portugal", "Alemania", "Paises Bajos", "Italia"]
CITIES = ["Madrid", "Marsella", "Lisboa", "Berlin", "Rotterdam", "Milan"]
PORTS = ["Algeciras", "Motril", "Valencia", "Barcelona", "Marsella", "Rotterdam", "Lisboa", "Hamburgo", "Milan Hub",
         "Lyon Hub", "Madrid Air", "Frankfurt Air"]
PORT_COUNTRIES = ["Espana", "Espana", "Espana", "Espana", "Francia", "Paises Bajos", "Portugal", "Alemania", "Italia",
                  "Francia", "Espana", "Alemania"]
PORT_KINDS = ["maritimo"] * 8 + ["terrestre"] * 2 + ["aereo"] * 2
ORDER_STATES = ["entregado", "confirmado", "enviado", "pendiente", "entregado"]

BASE_ORDERS, ALL_ORDERS = 180, 360


def day(text: str):
    return F.to_date(F.lit(text))


def reference_oltp(spark: SparkSession, t: Mapping[str, DataFrame]) -> Mapping[str, Callable[[], DataFrame]]:
    """Builders of all 27 OLTP tables; orders 181 to 360 are the later increment."""
    g = F.col("g")
    first = g - 1

    def base_and_later(base, later):
        return F.when(g <= BASE_ORDERS, base).otherwise(later)

    def order_dates():
        n = g - BASE_ORDERS
        later = F.when(n <= 60, F.date_add(day("2022-02-01"), (n * 5).cast("int"))) \
            .when(n <= 120, F.date_add(day("2023-02-01"), ((n - 60) * 5).cast("int"))) \
            .otherwise(F.date_add(day("2025-02-01"), ((n - 120) * 5).cast("int")))
        return base_and_later(F.date_add(day("2024-02-01"), (g * 2).cast("int")), later)

    def farms():
        return series(spark, 1, 60).select(
            g.alias("finca_id"), F.concat(F.lit("Finca_"), zero_pad(g, 3)).alias("nombre_finca"),
            dec(18 + (g % 17) * num("1.65"), 10, 2).alias("superficie_total_hectareas"),
            cycle(FARM_TOWNS, g).alias("municipio"), cycle(FARM_PROVINCES, g).alias("provincia"),
            cycle(["Costa Mediterranea", "Costa Atlantica"], g).alias("zona_agricola"),
            cycle(["Franco-arenoso", "Franco-arcilloso", "Limoso", "Franco"], g).alias("tipo_suelo"),
            cycle(["Goteo", "Aspersion", "Microaspersion"], g).alias("sistema_riego"))

    def plots():
        crops = ["Tomate", "Pimiento", "Pepino", "Aguacate", "Fresa", "Naranja", "Limon", "Calabacin", "Frambuesa",
                 "Arandano"]
        return series(spark, 1, 120).select(
            g.alias("parcela_id"), (first % 60 + 1).alias("finca_id"),
            F.concat(F.lit("Parcela_"), zero_pad(g, 3)).alias("nombre_parcela"),
            dec(num("2.50") + (g % 8) * num("0.70"), 8, 2).alias("superficie_hectareas"),
            cycle(crops, g).alias("cultivo_actual"), add_days(day("2023-01-01"), g * 6).alias("fecha_ultima_rotacion"))

    def campaigns():
        year = (2000 + g).cast("int")
        return series(spark, 1, 60).select(
            g.alias("campania_id"),
            F.concat_ws("_", F.lit("Campania"), year, year + 1).alias("nombre_campania"),
            F.make_date(year, F.lit(9), F.lit(1)).alias("fecha_inicio"),
            F.make_date(year + 1, F.lit(8), F.lit(31)).alias("fecha_fin"),
            F.lit("Otono-Primavera").alias("temporada"), (year + 1).alias("anio_agricola"),
            F.lit(None).cast("string").alias("observaciones_climaticas"))

    def crops():
        return series(spark, 1, 60).select(
            g.alias("cultivo_id"), cycle(CROPS, first).alias("nombre_producto"),
            cycle(FAMILIES, first).alias("familia_producto"),
            F.concat(cycle(VARIETIES, first), F.lit("_V"), F.expr("(g - 1) div 12 + 1").cast("string")).alias("variedad"),
            (70 + g % 180).cast("int").alias("ciclo_dias"),
            dec(2200 + (g % 15) * 180, 12, 2).alias("riego_necesario_litros_hectarea"))

    def harvests():
        return series(spark, 1, 180).select(
            g.alias("cosecha_id"), (first % 120 + 1).alias("parcela_id"), (first % 60 + 1).alias("cultivo_id"),
            (first % 6 + 20).alias("campania_id"), add_days(day("2024-01-10"), g * 3).alias("fecha_cosecha"),
            dec(900 + (g % 30) * 42, 10, 2).alias("kilos_cosechados"),
            dec(3200 + (g % 25) * 135, 12, 2).alias("rendimiento_kg_hectarea"),
            dec(650 + (g % 35) * 31, 12, 2).alias("coste_produccion"),
            dec(num("1.50") + (g % 10) * num("0.65"), 5, 2).alias("merma_campo_porcentaje"),
            (1 + g % 4).cast("int").alias("numero_recolecciones"))

    def customers():
        return series(spark, 1, 60).select(
            g.alias("cliente_id"), F.concat(F.lit("Cliente_"), zero_pad(g, 3)).alias("nombre_cliente"),
            F.concat(F.lit("B"), zero_pad(g, 8), F.lit("A")).alias("cif"),
            cycle(["mayorista", "distribuidor", "minorista", "retail"], g).alias("tipo_cliente"),
            cycle(["directo", "intermediario", "plataforma"], g).alias("canal"),
            cycle(["premium", "estandar", "ocasional"], g).alias("segmento"),
            cycle(COUNTRIES, g).alias("pais"), cycle(CITIES, g).alias("ciudad"),
            F.concat(F.lit("Calle Comercial "), g.cast("string")).alias("direccion"),
            F.concat(F.lit("28"), zero_pad(100 + g, 3)).alias("codigo_postal"),
            F.concat(F.lit("+34-600-"), (100000 + g).cast("string")).alias("telefono"),
            F.concat(F.lit("cliente"), g.cast("string"), F.lit("@example.com")).alias("email"),
            add_days(day("2023-01-01"), g * 5).alias("fecha_alta"))

    def orders():
        requested = base_and_later(F.lit(4), F.lit(5))
        return series(spark, 1, ALL_ORDERS).select(
            g.alias("pedido_id"), (first % 60 + 1).alias("cliente_id"), (first % 60 + 1).alias("contrato_id"),
            order_dates().alias("fecha_pedido"), add_days(order_dates(), requested).alias("fecha_entrega_solicitada"),
            base_and_later(cycle(ORDER_STATES, g), F.lit("entregado")).alias("estado"),
            F.lit("Pedido de exportacion").alias("observaciones"))

    def order_lines():
        order = F.col("pedido_id")
        products = t["lotes_origen"].join(t["cosechas"], "cosecha_id").join(t["cultivos"], "cultivo_id").select(
            "lote_id", F.col("nombre_producto").alias("producto"), "variedad")
        lines = t["pedidos"].select("pedido_id", "contrato_id", ((order - 1) % 180 + 1).alias("lote_id")) \
            .join(t["contratos"], "contrato_id").join(products, "lote_id").select(
                order.alias("detalle_id"), "pedido_id", "lote_id", "producto", "variedad",
                dec(120 + (order % 60) * 4, 10, 2).alias("kilos_solicitados"),
                (10 + order % 8).cast("int").alias("cajas_solicitadas"),
                F.col("descuento_general_porcentaje").alias("descuento_porcentaje"))
        return derive.price_lines(lines, derive.base_price("producto"))

    def forwarders():
        return series(spark, 1, 60).select(
            g.alias("transitario_id"), F.concat(F.lit("Transitario_"), zero_pad(g, 3)).alias("nombre_transitario"),
            F.concat(F.lit("A"), (50000000 + g).cast("string"), F.lit("Z")).alias("cif"),
            cycle(COUNTRIES[:5], g).alias("pais"),
            F.concat(F.lit("+34-700-"), (100000 + g).cast("string")).alias("telefono"),
            F.concat(F.lit("ops"), g.cast("string"), F.lit("@example.com")).alias("email"),
            cycle(["maritimo", "terrestre", "aereo", "multimodal"], g).alias("tipo_transporte"),
            dec(num("0.22") + (g % 5) * num("0.04"), 10, 2).alias("tarifa_base_kg"))

    def ports():
        return series(spark, 1, 60).select(
            g.alias("puerto_id"), F.concat(cycle(PORTS, g), F.lit("_"), zero_pad(g, 2)).alias("nombre_puerto"),
            cycle(PORTS, g).alias("ciudad"), cycle(PORT_COUNTRIES, g).alias("pais"), cycle(PORT_KINDS, g).alias("tipo"),
            F.concat(F.lit("LOC"), zero_pad(g, 6)).alias("codigo_un_locode"))

    def routes():
        return series(spark, 1, 120).select(
            g.alias("ruta_id"), (first % 60 + 1).alias("transitario_id"), (first % 20 + 1).alias("puerto_salida_id"),
            ((g + 9) % 60 + 1).alias("puerto_llegada_id"),
            cycle(["maritimo", "terrestre", "aereo", "multimodal"], first % 60).alias("tipo_transporte"),
            (2 + g % 7).cast("int").alias("duracion_estimada_dias"),
            dec(num("0.24") + (g % 6) * num("0.05"), 10, 2).alias("coste_base_kg"),
            F.concat(F.lit("Ruta operativa de exportacion "), g.cast("string")).alias("observaciones"))

    def shipments():
        order = F.col("pedido_id")
        base = order <= BASE_ORDERS
        route = F.when(base, (order - 1) % 120 + 1).otherwise((order - 1 - BASE_ORDERS) % 120 + 1)
        state = F.when(base, derive.shipment_state(order)).otherwise("entregado")
        return derive.shipments(t["pedidos"], derive.order_totals(t["detalle_pedido"]), t["rutas_logisticas"], route, state)

    def base_only(df, column):
        """Customs, incidents, invoices and payments exist for the first orders only."""
        return df.filter(F.col(column) <= BASE_ORDERS)

    return {
        "fincas": farms, "parcelas": plots, "campanias": campaigns, "cultivos": crops, "cosechas": harvests,
        "lotes_origen": lambda: derive.lots(t["cosechas"]),
        "lotes": lambda: derive.warehouse_lots(t["lotes_origen"], t["cosechas"], t["cultivos"]),
        "controles_calidad": lambda: derive.quality_controls(t["lotes"]),
        "calibres": lambda: derive.size_split(t["lotes"]),
        "certificados": lambda: derive.certificates(t["lotes"]),
        "incidencias_calidad": lambda: derive.quality_incidents(t["lotes"]),
        "clientes": customers, "contratos": lambda: contract_rows(t["clientes"], "2024-01-01", "2026-12-31"),
        "pedidos": orders, "detalle_pedido": order_lines,
        "tarifas": lambda: derive.price_list(t["cultivos"], "2024-01-01", "2026-12-31"),
        "transitarios": forwarders, "puertos": ports, "rutas_logisticas": routes, "envios": shipments,
        "aduanas": lambda: derive.customs(base_only(t["envios"], "envio_id"), t["rutas_logisticas"], t["puertos"]),
        "incidencias_envio": lambda: derive.shipment_incidents(base_only(t["envios"], "envio_id")),
        "facturas": lambda: derive.invoices(
            t["pedidos"], derive.order_totals(base_only(t["detalle_pedido"], "pedido_id"))),
        "cobros": lambda: derive.payments(t["facturas"]),
        "costes_lote": lambda: derive.lot_costs(t["lotes_origen"]),
        "costes_logisticos": lambda: derive.shipping_costs(t["envios"]),
        "tipos_cambio": lambda: derive.exchange_rates(
            series(spark, 1, 60).select(g, add_days(day("2024-01-01"), g).alias("fecha"))),
    }


def base_oltp(spark: SparkSession, t: Mapping[str, DataFrame]) -> Mapping[str, Callable[[], DataFrame]]:
    """The warehouse before the increment: 180 orders."""
    builders = dict(reference_oltp(spark, t))
    orders = builders["pedidos"]
    builders["pedidos"] = lambda: orders().filter(F.col("pedido_id") <= BASE_ORDERS)
    return builders
