"""Analytical questions over the OLTP, star and snowflake layouts.

A question is data: group keys, sums and means. All layouts answer it through
:func:`answer`, which differs only in the frame of lines it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..functions.numbers import safe_ratio
from ..operators.joins import is_small, lean_join, sized_join, skew_join
from ..session import written
from .snow import products_with_family
from .star import commercial_category, dominant_size, route_attributes

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Question:
    """``sums`` and ``means`` map result names to names of :data:`MEASURES`."""

    keys: tuple[str, ...]
    sums: Mapping[str, str]
    means: Mapping[str, str]


QUESTIONS = {
    "a1": Question(
        ("anio", "trimestre", "nombre_campania", "familia_producto", "nombre_producto", "variedad", "pais"),
        {"ingresos": "neto", "costeproducto": "coste_producto", "costelogistico": "coste_logistico", "margen": "margen"},
        {}),
    "a2": Question(
        ("nombre_finca", "nombre_campania", "familia_producto", "nombre_producto"),
        {"kilos_vendidos": "kilos", "margen": "margen"}, {}),
    "a3": Question(
        ("familia_producto", "nombre_cliente", "pais"),
        {"kilos_vendidos": "kilos", "margen": "margen"}, {"precio_medio_kg": "precio_kg"}),
    "a4": Question(
        ("familia_producto", "nombre_transitario", "puerto_salida", "puerto_llegada"),
        {}, {"tiempo_medio_entrega": "dias", "costelogisticomediokg": "logistico_kg"}),
    "a5": Question(
        ("familia_producto", "categoria_comercial", "calibre", "tipo_certificado"),
        {"margentotal": "margen"}, {"preciomediokg": "precio_kg"}),
    "a6": Question(
        ("anio", "trimestre", "nombre_producto", "variedad", "pais", "nombre_campania"),
        {"ingresos": "neto", "coste_prod": "coste_producto", "coste_log": "coste_logistico", "margen": "margen"}, {}),
    "a7": Question(
        ("familia_producto",),
        {"ingresos_reales": "neto", "costes_totales": "coste_total", "margen_total": "margen"}, {}),
}

#: Which dimension holds which group key.
HOME = {
    "anio": "dim_tiempo", "trimestre": "dim_tiempo", "nombre_campania": "dim_campania",
    "familia_producto": "dim_producto", "nombre_producto": "dim_producto", "variedad": "dim_producto",
    "pais": "dim_geografia", "nombre_finca": "dim_finca", "nombre_cliente": "dim_cliente",
    "nombre_transitario": "dim_logistica", "puerto_salida": "dim_logistica", "puerto_llegada": "dim_logistica",
    "categoria_comercial": "dim_calidad", "calibre": "dim_calidad", "tipo_certificado": "dim_calidad",
}



def fact_measure(name: str) -> Column:
    """Measures as the fact stores them, rounded per line."""
    return {
        "neto": F.col("importe_neto"), "kilos": F.col("kilos_vendidos"),
        "coste_producto": F.col("coste_producto"), "coste_logistico": F.col("coste_logistico"),
        "coste_total": F.col("coste_total"), "margen": F.col("margen"),
        "precio_kg": F.col("precio_medio_kg"), "dias": F.col("tiempo_entrega_dias").cast("decimal(10,0)"),
        "logistico_kg": safe_ratio("coste_logistico", "kilos_vendidos"),
    }[name]


def line_measure(name: str) -> Column:
    """Measures on an OLTP line: products and ratios stay unrounded until summed."""
    kilos, net = F.col("kilos_solicitados"), F.col("importe_neto")
    product, logistic = kilos * F.col("producto_kg"), kilos * F.col("logistico_kg")
    return {
        "neto": net, "kilos": kilos, "coste_producto": product, "coste_logistico": logistic,
        "coste_total": product + logistic, "margen": net - product - logistic,
        "precio_kg": safe_ratio(net, kilos), "dias": F.col("dias").cast("decimal(10,0)"),
        "logistico_kg": F.col("logistico_kg"),
    }[name]


def partial_sums(lines: DataFrame, keys: Sequence[str], q: Question, measure) -> DataFrame:
    """Sum and count per group: what can be added up again later."""
    return lines.groupBy(*keys).agg(
        *[F.sum(measure(m)).alias(f"_s_{n}") for n, m in {**q.sums, **q.means}.items()],
        *[F.count(measure(m)).alias(f"_n_{n}") for n, m in q.means.items()],
    )


def final_columns(q: Question) -> list[Column]:
    """Measures from summed sums and counts: exact decimals, so results do not depend on row order."""
    sums = [F.sum(f"_s_{n}").cast("decimal(24,2)").alias(n) for n in q.sums]
    means = [
        F.round(F.sum(f"_s_{n}") / F.nullif(F.sum(f"_n_{n}"), F.lit(0)), 6).cast("decimal(18,6)").alias(n)
        for n in q.means
    ]
    return sums + means


def direct_columns(q: Question, measure) -> list[Column]:
    sums = [F.sum(measure(m)).cast("decimal(24,2)").alias(n) for n, m in q.sums.items()]
    means = [
        F.round(F.sum(measure(m)) / F.nullif(F.count(measure(m)), F.lit(0)), 6).cast("decimal(18,6)").alias(n)
        for n, m in q.means.items()
    ]
    return sums + means


def answer(lines: DataFrame, q: Question, measure) -> DataFrame:
    return lines.groupBy(*q.keys).agg(*direct_columns(q, measure))


def ask_dimensional(fact: DataFrame, dims: Mapping[str, DataFrame], q: Question, pre_aggregate: bool | None = None) -> DataFrame:
    """Answer ``q`` over a fact and its dimensions.

    Dimensions that fit a broadcast are joined first, without a shuffle. If all
    do, that is the whole plan. One large dimension is joined by key (hot keys
    salted), after which the groups combine where the key's rows already are. With
    more of them the fact would be shuffled in full for each, so it is aggregated
    by the attributes found so far and the large dimensions' keys before they are joined.
    """
    needed: dict[str, list[str]] = {}
    for key in q.keys:
        needed.setdefault(HOME[key], []).append(key)
    sides = {name: dims[name].select(SK[name], *columns) for name, columns in needed.items()}
    small = [n for n, side in sides.items() if is_small(side)]
    large = [n for n in sides if n not in small]
    if pre_aggregate is None:
        pre_aggregate = len(large) > 1
    if not pre_aggregate:
        for name in [*large, *small]:  # the fact is moved before attributes widen it
            fact = skew_join(fact, sides[name], SK[name])
        return answer(fact, q, fact_measure)
    for name in small:
        fact = fact.join(sides[name], SK[name])
    found = [k for n in small for k in needed[n]]
    reduced = partial_sums(fact, [*found, *[SK[n] for n in large]], q, fact_measure)
    for name in large:
        reduced = sized_join(reduced, sides[name], SK[name])
    return reduced.groupBy(*q.keys).agg(*final_columns(q))


SK = {
    "dim_tiempo": "tiempo_sk", "dim_campania": "campania_sk", "dim_cliente": "cliente_sk",
    "dim_geografia": "geografia_sk", "dim_finca": "finca_sk", "dim_producto": "producto_sk",
    "dim_calidad": "calidad_sk", "dim_logistica": "logistica_sk",
}


def ask_star(star: Tables, q: Question) -> DataFrame:
    return ask_dimensional(star["fact_exportaciones"], star, q)


class _Snow(Mapping):
    """Snowflake tables with the product dimension read through its family.

    Products and families are joined and written once for an answer: their true size,
    not the product of two estimates, decides how the fact meets them.
    """

    def __init__(self, snow: Tables):
        self._snow = snow

    def __getitem__(self, name: str) -> DataFrame:
        if name != "dim_producto":
            return self._snow[name]
        named = [k for k, home in HOME.items() if home == name]
        return written(products_with_family(self._snow).select(SK[name], *named), "products")

    def __iter__(self):
        return iter(self._snow)

    def __len__(self):
        return len(self._snow)


def ask_snow(snow: Tables, q: Question) -> DataFrame:
    return ask_dimensional(snow["fact_exportaciones"], _Snow(snow), q)


_ORDER_COLUMNS = {"anio", "trimestre", "pais", "nombre_cliente", "nombre_transitario", "puerto_salida",
                  "puerto_llegada"}


def oltp_orders(t: Tables, columns: Sequence[str], hot: Mapping[str, Sequence[int]], keep: Sequence[str] = ()) -> DataFrame:
    """Order-grain half of the chain: order, shipment, logistic cost and what ``columns`` ask for (with the keys to ``keep``)."""
    wanted = set(columns)
    shipped = t["envios"].select(
        "pedido_id", "envio_id", "ruta_id", days_between("fecha_envio", "fecha_entrega_real").alias("dias"))
    cost = t["costes_logisticos"].select("envio_id", F.col("coste_por_kg").alias("logistico_kg"))
    orders = t["pedidos"].select(
        "pedido_id", "cliente_id", F.year("fecha_pedido").alias("anio"), F.quarter("fecha_pedido").alias("trimestre"))
    orders = sized_join(sized_join(orders, shipped, "pedido_id"), cost, "envio_id")
    if wanted & {"pais", "nombre_cliente"}:
        orders = skew_join(orders, t["clientes"].select("cliente_id", "pais", "nombre_cliente"), "cliente_id",
                           hot=hot.get("cliente_id", ()))
    if wanted & {"nombre_transitario", "puerto_salida", "puerto_llegada"}:
        routes = route_attributes(t["rutas_logisticas"], t["transitarios"], t["puertos"])
        legs = routes.select("ruta_id", "nombre_transitario", "puerto_salida", "puerto_llegada")
        orders = skew_join(orders, legs, "ruta_id", hot=hot.get("ruta_id", ()))
    return orders.select("pedido_id", "logistico_kg", "dias", *[c for c in columns if c in _ORDER_COLUMNS], *keep)


def oltp_lots(t: Tables, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Lot-grain half of the chain: lot, harvest, crop, cost and what ``columns`` ask for (with the keys to ``keep``)."""
    wanted = set(columns)
    lots = t["costes_lote"].select("lote_id", F.col("coste_por_kg").alias("producto_kg"))
    lots = lean_join(lots, t["lotes_origen"].select("lote_id", "cosecha_id"), "lote_id")
    lots = lean_join(lots, t["cosechas"].select("cosecha_id", "parcela_id", "cultivo_id", "campania_id"), "cosecha_id")
    lots = lean_join(lots, t["cultivos"].select("cultivo_id", "familia_producto", "nombre_producto", "variedad"), "cultivo_id")
    if "nombre_campania" in wanted:
        lots = lean_join(lots, t["campanias"].select("campania_id", "nombre_campania"), "campania_id")
    if "nombre_finca" in wanted:
        farms = sized_join(t["parcelas"].select("parcela_id", "finca_id"), t["fincas"].select("finca_id", "nombre_finca"), "finca_id")
        lots = sized_join(lots, farms.select("parcela_id", "nombre_finca"), "parcela_id")
    if wanted & {"categoria_comercial", "calibre", "tipo_certificado"}:
        lots = lean_join(lots, _lot_quality(t), "lote_id")
    return lots.select("lote_id", "producto_kg", *[c for c in columns if c not in _ORDER_COLUMNS], *keep)


def _lot_quality(t: Tables) -> DataFrame:
    category = commercial_category("porcentaje_primera_categoria").alias("categoria_comercial")
    quality = lean_join(t["controles_calidad"].select("lote_id", category), dominant_size(t["calibres"]), "lote_id")
    return lean_join(quality, t["certificados"].select("lote_id", "tipo_certificado"), "lote_id")


#: Which half of the chain a group key's tables are optional in, by the flag that says whether they know the row.
_FLAGS = {
    "pais": "_cliente", "nombre_cliente": "_cliente", "nombre_transitario": "_ruta", "puerto_salida": "_ruta", "puerto_llegada": "_ruta",
    "nombre_campania": "_campania", "nombre_finca": "_finca", "categoria_comercial": "_calidad", "calibre": "_calidad", "tipo_certificado": "_calidad",
}


def full_orders(t: Tables, hot: Mapping[str, Sequence[int]]) -> DataFrame:
    """The order half for every question: what a question may do without is joined outer, with a flag."""
    orders = oltp_orders(t, ["anio", "trimestre"], hot, ["cliente_id", "ruta_id"])
    customers = t["clientes"].select("cliente_id", "pais", "nombre_cliente", F.lit(True).alias("_cliente"))
    routes = route_attributes(t["rutas_logisticas"], t["transitarios"], t["puertos"])
    legs = routes.select("ruta_id", "nombre_transitario", "puerto_salida", "puerto_llegada", F.lit(True).alias("_ruta"))
    orders = skew_join(orders, customers, "cliente_id", "left", hot=hot.get("cliente_id", ()))
    return skew_join(orders, legs, "ruta_id", "left", hot=hot.get("ruta_id", ())).drop("cliente_id", "ruta_id")


def full_lots(t: Tables) -> DataFrame:
    """The lot half for every question, as :func:`full_orders`."""
    lots = oltp_lots(t, ["familia_producto", "nombre_producto", "variedad"], ["campania_id", "parcela_id"])
    campaigns = t["campanias"].select("campania_id", "nombre_campania", F.lit(True).alias("_campania"))
    farms = sized_join(t["parcelas"].select("parcela_id", "finca_id"), t["fincas"].select("finca_id", "nombre_finca"), "finca_id").select(
        "parcela_id", "nombre_finca", F.lit(True).alias("_finca"))
    quality = _lot_quality(t).withColumn("_calidad", F.lit(True))
    lots = sized_join(lean_join(lots, campaigns, "campania_id", "left"), farms, "parcela_id", "left")
    lots = lean_join(lots, quality, "lote_id", "left")
    return lots.drop("campania_id", "parcela_id")


def chain(t: Tables, hot: Callable[[], Mapping[str, Sequence[int]]]) -> dict:
    """Builders of both halves, by the key they meet the lines on: stored once, every question reads its columns of them."""
    return {"lote_id": lambda: full_lots(t), "pedido_id": lambda: full_orders(t, hot())}


def _from_stored(half: DataFrame, key: str, q: Question) -> DataFrame:
    own = [c for c in q.keys if c in half.columns]
    known = [flag for flag in dict.fromkeys(_FLAGS.get(c) for c in own) if flag]
    for flag in known:
        half = half.filter(F.col(flag))
    return half.select(key, *(["producto_kg"] if key == "lote_id" else ["logistico_kg", "dias"]), *own)


def oltp_lines(t: Tables, q: Question, hot: Mapping[str, Sequence[int]] | None = None, halves: Tables | None = None) -> DataFrame:
    """Lines with the group keys of ``q`` and what :func:`line_measure` needs.

    The chain of up to eleven tables is joined as two small halves, at order and
    at lot grain, that meet on the line table. ``halves`` gives them as :func:`chain`
    stores them, else this question's are written once: their true size, not the
    product of estimates, decides how the lines meet them. ``hot`` lists, per key
    column, the values that hold a large share of the rows referring to them; they are salted.
    """
    hot = hot or {}
    lines = t["detalle_pedido"].select("pedido_id", "lote_id", "kilos_solicitados", "importe_neto")
    for key in ("lote_id", "pedido_id"):
        if halves is not None:
            half = _from_stored(halves[key], key, q)
        else:
            half = written(oltp_lots(t, q.keys) if key == "lote_id" else oltp_orders(t, q.keys, hot), f"half-{key}")
        lines = skew_join(lines, half, key, hot=hot.get(key, ()))
    return lines


def ask_oltp(t: Tables, q: Question, hot: Mapping[str, Sequence[int]] | None = None, halves: Tables | None = None) -> DataFrame:
    """Answer ``q`` over the normalised tables (see :func:`oltp_lines`)."""
    return answer(oltp_lines(t, q, hot, halves), q, line_measure)


def measured(lines: DataFrame, q: Question, measure) -> DataFrame:
    """Lines with the group keys of ``q`` and its sums' measures, not aggregated yet."""
    return lines.select(*q.keys, *[measure(m).alias(n) for n, m in q.sums.items()])


def dimensional_lines(fact: DataFrame, dims: Mapping[str, DataFrame], q: Question) -> DataFrame:
    """The fact with the group keys of ``q``, not aggregated; it meets the dimensions that move it first, while it has no attributes."""
    sides = {name: dims[name].select(SK[name], *[k for k in q.keys if HOME[k] == name]) for name in dict.fromkeys(HOME[key] for key in q.keys)}
    for name in sorted(sides, key=lambda n: is_small(sides[n])):
        fact = skew_join(fact, sides[name], SK[name])
    return fact


def build_aggregate(star: Tables, fact: DataFrame | None = None) -> DataFrame:
    """Quarterly revenue aggregate, to be written and refreshed after loads."""
    q = QUESTIONS["a6"]
    return ask_dimensional(star["fact_exportaciones"] if fact is None else fact, star, q)


def aggregate_lines(star: Tables, fact: DataFrame) -> DataFrame:
    """Lines of the fact with the columns of :func:`build_aggregate`, for :func:`refresh_aggregate` to add."""
    q = QUESTIONS["a6"]
    lines = fact.select(*dict.fromkeys(SK[HOME[key]] for key in q.keys), *[fact_measure(m).alias(n) for n, m in q.sums.items()])
    return dimensional_lines(lines, star, q).select(*q.keys, *q.sums)


def refresh_aggregate(old: DataFrame, delta: DataFrame) -> DataFrame:
    """Incremental refresh: all measures are sums, so the delta, aggregated or not, is added to the old aggregate."""
    q = QUESTIONS["a6"]
    both = old.unionByName(delta)
    return both.groupBy(*q.keys).agg(*[F.sum(n).cast("decimal(24,2)").alias(n) for n in q.sums])
