"""OLTP tables read from order-management tables (region, nation, customer, supplier, part, orders, lineitem).

Parts are crops with one harvest and one lot each, suppliers are farms and
forwarders, nations are ports, line items are order lines. Plain projections stay
views that Catalyst prunes; only what needs a shuffle is stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_days
from ..functions.numbers import dec, money, rounded, safe_ratio
from ..functions.text import cycle, map_values, zero_pad
from ..sources.tables import read_table
from . import derive
from .derive import num
from .star import Catalog
from .warehouse import Warehouse

#: Tables read more than once that take a shuffle to build.
STORED = ("campanias", "envios", "costes_logisticos", "costes_lote")

ORDER_STATES = {"O": "pendiente", "P": "enviado", "F": "entregado"}



def _nations(*numbers: int) -> tuple[str, ...]:
    return tuple(f"NATION_{n}" for n in numbers)


#: Bands for these nations and part names.
CATALOG = Catalog(
    south=_nations(0, 5, 10, 15, 20), centre=_nations(1, 6, 11, 16, 21),
    punnet=("small ring", "red ring", "hot ring"), boxed=("red widget", "small widget", "blue widget"),
    bulk=("blue bolt", "red bolt", "large bolt", "small bolt"),
)


def agricultural_year(c: Column | str) -> Column:
    """Year the campaign of a date starts in: campaigns run from 1 September to 31 August."""
    return F.year(c) - F.when(F.month(c) < 9, 1).otherwise(0)


def _campaign_rows(starts: DataFrame) -> DataFrame:
    year = F.col("inicio")
    return starts.select(
        year.cast("bigint").alias("campania_id"),
        F.concat(F.lit("Campania_"), year.cast("string"), F.lit("_"), (year + 1).cast("string")).alias("nombre_campania"),
        F.make_date(year, F.lit(9), F.lit(1)).alias("fecha_inicio"),
        F.make_date(year + 1, F.lit(8), F.lit(31)).alias("fecha_fin"),
        F.lit("Otono-Primavera").alias("temporada"),
        (year + 1).alias("anio_agricola"),
        F.lit(None).cast("string").alias("observaciones_climaticas"),
    )


def oltp_builders(spark: SparkSession, folder: str, t: Mapping[str, DataFrame]) -> Mapping[str, Callable[[], DataFrame]]:
    """Builders of all OLTP tables over the parquet tables in ``folder``."""

    def src(name: str) -> DataFrame:
        return read_table(spark, folder, name)

    def rows_in(name: str):
        """Row count as a scalar subquery: answered from the parquet footers."""
        return src(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    def farms() -> DataFrame:
        s = src("supplier").join(src("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        s = s.join(src("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        key = F.col("s_suppkey")
        return s.select(
            (key + 1).alias("finca_id"), F.col("s_name").alias("nombre_finca"),
            dec(18 + (key % 17) * num("1.65"), 10, 2).alias("superficie_total_hectareas"),
            F.col("n_name").alias("municipio"), F.col("r_name").alias("provincia"),
            cycle(["Costa Mediterranea", "Costa Atlantica"], key).alias("zona_agricola"),
            cycle(["Franco-arenoso", "Franco-arcilloso", "Limoso", "Franco"], key).alias("tipo_suelo"),
            cycle(["Goteo", "Aspersion", "Microaspersion"], key).alias("sistema_riego"),
        )

    def plots() -> DataFrame:
        half = F.explode(F.array(F.lit(1), F.lit(2))).alias("half")
        plot = F.col("s_suppkey") * 2 + F.col("half")
        return src("supplier").select("s_suppkey", half).select(
            plot.alias("parcela_id"), (F.col("s_suppkey") + 1).alias("finca_id"),
            F.concat(F.lit("Parcela_"), zero_pad(plot, 12)).alias("nombre_parcela"),
            dec(num("2.50") + (plot % 8) * num("0.70"), 8, 2).alias("superficie_hectareas"),
            F.lit("varios").alias("cultivo_actual"),
            add_days(F.lit("1995-01-01").cast("date"), (plot % 365).cast("int")).alias("fecha_ultima_rotacion"),
        )

    def campaigns() -> DataFrame:
        # Every year between the first and the last harvest or order, so that no line loses its campaign.
        ordered = src("orders").select(agricultural_year("o_orderdate").alias("inicio"))
        harvested = t["cosechas"].select(F.col("campania_id").cast("int").alias("inicio"))
        return _campaign_rows(ordered.union(harvested).distinct())

    def crops() -> DataFrame:
        return src("part").select(
            (F.col("p_partkey") + 1).alias("cultivo_id"), F.col("p_name").alias("nombre_producto"),
            F.col("p_type").alias("familia_producto"), F.col("p_brand").alias("variedad"),
            (70 + F.col("p_size")).alias("ciclo_dias"),
            money("p_retailprice").alias("riego_necesario_litros_hectarea"),
        )

    def harvests() -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        year = (1995 + key % 6).cast("int")
        plots_in_all = rows_in("supplier") * 2
        return src("part").select(
            (key + 1).alias("cosecha_id"),
            (key % plots_in_all + 1).alias("parcela_id"),
            (key + 1).alias("cultivo_id"),
            year.cast("bigint").alias("campania_id"),
            add_days(F.make_date(year, F.lit(10), F.lit(1)), size).alias("fecha_cosecha"),
            dec(900 + size * 42, 10, 2).alias("kilos_cosechados"),
            dec(3200 + size * 135, 12, 2).alias("rendimiento_kg_hectarea"),
            money("p_retailprice").alias("coste_produccion"),
            dec(num("1.50") + (key % 10) * num("0.65"), 5, 2).alias("merma_campo_porcentaje"),
            (1 + key % 4).cast("int").alias("numero_recolecciones"),
        )

    def customers() -> DataFrame:
        c = src("customer").join(src("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        key = F.col("c_custkey")
        return c.select(
            (key + 1).alias("cliente_id"), F.col("c_name").alias("nombre_cliente"),
            F.concat(F.lit("B"), zero_pad(key + 1, 8), F.lit("A")).alias("cif"),
            cycle(["mayorista", "distribuidor", "minorista", "retail"], key).alias("tipo_cliente"),
            cycle(["directo", "intermediario", "plataforma"], key).alias("canal"),
            F.lower("c_mktsegment").alias("segmento"),
            F.col("n_name").alias("pais"),
            F.concat("n_name", F.lit("-"), (key % 4).cast("string")).alias("ciudad"),
            F.concat(F.lit("Calle Comercial "), key.cast("string")).alias("direccion"),
            zero_pad(key % 100000, 5).alias("codigo_postal"),
            F.concat(F.lit("+34-600-"), zero_pad(key % 1000000, 6)).alias("telefono"),
            F.concat(F.lit("cliente"), key.cast("string"), F.lit("@example.com")).alias("email"),
            add_days(F.lit("1990-01-01").cast("date"), (key % 1800).cast("int")).alias("fecha_alta"),
        )

    def contracts() -> DataFrame:
        return contract_rows(t["clientes"], "1995-01-01", "2001-12-31")

    def orders() -> DataFrame:
        day = F.to_date("o_orderdate")
        return src("orders").select(
            (F.col("o_orderkey") + 1).alias("pedido_id"), (F.col("o_custkey") + 1).alias("cliente_id"),
            (F.col("o_custkey") + 1).alias("contrato_id"), day.alias("fecha_pedido"),
            add_days(day, 4).alias("fecha_entrega_solicitada"),
            map_values("o_orderstatus", ORDER_STATES).alias("estado"),
            F.col("o_orderpriority").alias("observaciones"),
        )

    def order_lines() -> DataFrame:
        quantity, gross = dec("l_quantity", 10, 2), money("l_extendedprice")
        discount = dec(dec("l_discount", 5, 2) * 100, 5, 2)
        return src("lineitem").select(
            ((F.col("l_orderkey") + 1) * 100 + F.col("l_linenumber")).cast("bigint").alias("detalle_id"),
            (F.col("l_orderkey") + 1).alias("pedido_id"), (F.col("l_partkey") + 1).alias("lote_id"),
            quantity.alias("kilos_solicitados"),
            F.ceil(F.col("l_quantity") / 5).cast("int").alias("cajas_solicitadas"),
            rounded(safe_ratio(gross, quantity), 2, 10).alias("precio_unitario_kg"),
            discount.alias("descuento_porcentaje"),
            gross.alias("importe_bruto"),
            rounded(gross * (1 - dec("l_discount", 5, 2)), 2).alias("importe_neto"),
        )

    def forwarders() -> DataFrame:
        s = src("supplier").join(src("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        key = F.col("s_suppkey")
        return s.select(
            (key + 1).alias("transitario_id"),
            F.concat(F.lit("Transitario_"), zero_pad(key + 1, 12)).alias("nombre_transitario"),
            F.concat(F.lit("A"), zero_pad(key + 1, 8), F.lit("Z")).alias("cif"), F.col("n_name").alias("pais"),
            F.concat(F.lit("+34-700-"), zero_pad(key % 1000000, 6)).alias("telefono"),
            F.concat(F.lit("ops"), key.cast("string"), F.lit("@example.com")).alias("email"),
            cycle(["maritimo", "terrestre", "aereo", "multimodal"], key).alias("tipo_transporte"),
            dec(num("0.22") + (key % 5) * num("0.04"), 10, 2).alias("tarifa_base_kg"),
        )

    def ports() -> DataFrame:
        key = F.col("n_nationkey")
        return src("nation").select(
            (key + 1).cast("bigint").alias("puerto_id"), F.concat(F.lit("Puerto "), "n_name").alias("nombre_puerto"),
            F.col("n_name").alias("ciudad"), F.col("n_name").alias("pais"),
            cycle(["maritimo", "aereo", "terrestre"], key).alias("tipo"),
            F.concat(F.lit("LOC"), zero_pad(key + 1, 6)).alias("codigo_un_locode"),
        )

    def routes() -> DataFrame:
        key = F.col("s_suppkey")
        return src("supplier").select(
            (key + 1).alias("ruta_id"), (key + 1).alias("transitario_id"),
            (F.col("s_nationkey") + 1).cast("bigint").alias("puerto_salida_id"),
            ((F.col("s_nationkey") + key * 7 + 3) % rows_in("nation") + 1).cast("bigint").alias("puerto_llegada_id"),
            cycle(["maritimo", "terrestre", "aereo", "multimodal"], key).alias("tipo_transporte"),
            (2 + key % 7).cast("int").alias("duracion_estimada_dias"),
            dec(num("0.24") + (key % 6) * num("0.05"), 10, 2).alias("coste_base_kg"),
            F.concat(F.lit("Ruta operativa de exportacion "), key.cast("string")).alias("observaciones"),
        )

    def shipments() -> DataFrame:
        route = (F.col("pedido_id") - 1) % rows_in("supplier") + 1
        return derive.shipments(t["pedidos"], derive.order_totals(t["detalle_pedido"]), t["rutas_logisticas"], route)

    def rate_days() -> DataFrame:
        days = src("orders").select(F.to_date("o_orderdate").alias("fecha")).distinct()
        g = F.datediff("fecha", F.lit("1994-12-31").cast("date"))
        return derive.exchange_rates(days.select(g.alias("g"), "fecha"))

    return {
        "fincas": farms, "parcelas": plots, "campanias": campaigns, "cultivos": crops, "cosechas": harvests,
        "lotes_origen": lambda: derive.lots(t["cosechas"]).withColumn(
            "codigo_lote", F.concat(F.lit("LOT"), zero_pad("cosecha_id", 12))),
        "lotes": lambda: derive.warehouse_lots(t["lotes_origen"], t["cosechas"], t["cultivos"]),
        "controles_calidad": lambda: derive.quality_controls(t["lotes"]),
        "calibres": lambda: derive.size_split(t["lotes"]),
        "certificados": lambda: derive.certificates(t["lotes"]),
        "incidencias_calidad": lambda: derive.quality_incidents(t["lotes"]),
        "clientes": customers, "contratos": contracts, "pedidos": orders, "detalle_pedido": order_lines,
        "tarifas": lambda: derive.price_list(t["cultivos"], "1995-01-01", "2001-12-31", PART_PRICES),
        "transitarios": forwarders, "puertos": ports, "rutas_logisticas": routes, "envios": shipments,
        "aduanas": lambda: derive.customs(t["envios"], t["rutas_logisticas"], t["puertos"]),
        "incidencias_envio": lambda: derive.shipment_incidents(t["envios"]),
        "facturas": lambda: derive.invoices(t["pedidos"], derive.order_totals(t["detalle_pedido"])),
        "cobros": lambda: derive.payments(t["facturas"]),
        "costes_lote": lambda: derive.lot_costs(t["lotes_origen"]),
        "costes_logisticos": lambda: derive.shipping_costs(t["envios"]),
        "tipos_cambio": rate_days,
    }


#: Base price by part name, and by part family, for the pricing jobs.
PART_PRICES = {"small ring": "2.20", "red widget": "2.50", "blue bolt": "1.95", "hot gear": "3.80"}
FAMILY_PRICES = {"ECONOMY": "2.20", "SMALL": "2.50", "MEDIUM": "1.95", "LARGE": "3.80", "PROMO": "3.20"}


def contract_rows(customers: DataFrame, start: str, end: str) -> DataFrame:
    """contratos: one contract per customer."""
    key = F.col("cliente_id")
    return customers.select(
        key.alias("contrato_id"), "cliente_id",
        F.to_date(F.lit(start)).alias("fecha_inicio"), F.to_date(F.lit(end)).alias("fecha_fin"),
        cycle(["30 dias transferencia", "45 dias transferencia", "Contado"], key).alias("condiciones_pago"),
        dec(3 + key % 6, 5, 2).alias("descuento_general_porcentaje"),
        dec(500 + (key % 10) * 150, 10, 2).alias("volumen_minimo_kg"),
        dec(num("1.80") + (key % 7) * num("0.20"), 10, 2).alias("precio_base_kg"),
    )


_open: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse over ``folder``, shared by all queries of one Spark application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Warehouse(spark, lambda t: oltp_builders(spark, folder, t), STORED, CATALOG)
    return _open[key]
