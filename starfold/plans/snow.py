"""Snowflake model: the star with the product family in its own dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import number_dimension
from ..operators.lookup import key_map, rekey
from ..session import written

#: Natural key of each dimension, shared by both models.
NATURAL_KEYS = {
    "dim_tiempo": ("tiempo_sk", ["fecha"]),
    "dim_campania": ("campania_sk", ["campania_id"]),
    "dim_cliente": ("cliente_sk", ["cliente_id"]),
    "dim_geografia": ("geografia_sk", ["pais", "ciudad"]),
    "dim_finca": ("finca_sk", ["finca_id", "parcela"]),
    "dim_producto": ("producto_sk", ["cultivo_id"]),
    "dim_calidad": ("calidad_sk", ["lote_id"]),
    "dim_logistica": ("logistica_sk", ["ruta_id"]),
}


def family_dim(products: DataFrame) -> DataFrame:
    return number_dimension(products.select("familia_producto").distinct(), "familia_sk", ["familia_producto"])


def snow_product_dim(products: DataFrame, families: DataFrame) -> DataFrame:
    """Products that point to their family by key."""
    rows = products.drop("producto_sk").join(families, "familia_producto").select(
        "cultivo_id", "nombre_producto", "variedad", "familia_sk", "tipo_envase", "formato_comercial", "peso_unidad")
    return number_dimension(rows, "producto_sk", ["cultivo_id"])


def conformed_copy(star_dim: DataFrame, name: str) -> DataFrame:
    """The star dimension itself: both models number it in the order of its natural key, so the keys agree."""
    sk, _ = NATURAL_KEYS[name]
    return star_dim.select(sk, *[c for c in star_dim.columns if c != sk])


def dimensions(star: Mapping[str, DataFrame], snow: Mapping[str, DataFrame]) -> dict:
    """Builders of the snowflake dimensions; ``snow`` gives access to those built before."""
    builders = {
        name: (lambda n=name: conformed_copy(star[n], n)) for name in NATURAL_KEYS if name != "dim_producto"
    }
    builders["dim_familia_producto"] = lambda: family_dim(star["dim_producto"])
    builders["dim_producto"] = lambda: snow_product_dim(star["dim_producto"], snow["dim_familia_producto"])
    return builders


def snow_fact(fact: DataFrame, star: Mapping[str, DataFrame], snow: Mapping[str, DataFrame]) -> DataFrame:
    """The star fact with the products' keys of the snowflake model, through their natural key.

    The other dimensions are conformed: they are the star's, keys included.
    """
    sk, natural = NATURAL_KEYS["dim_producto"]
    # Written once: the pairs' true size, not an estimate of their join, decides how the fact meets them.
    return rekey(fact, {sk: written(key_map(star["dim_producto"], snow["dim_producto"], sk, natural), f"map-{sk}")})


#: Column of a stored fact that serves both models: how far the snowflake model's keys of the line's product lie from the star's.
SHIFTS = "_producto_shifts"


def product_shifts(star: Mapping[str, DataFrame], snow: Mapping[str, DataFrame]) -> DataFrame:
    """(product key of the star, :data:`SHIFTS`): a list, since natural keys may repeat, and mostly of one zero."""
    sk, natural = NATURAL_KEYS["dim_producto"]
    pairs = key_map(star["dim_producto"], snow["dim_producto"], sk, natural)
    return pairs.groupBy(sk).agg(F.collect_list(F.col("_new_sk") - F.col(sk)).alias(SHIFTS))


def snow_view(both: DataFrame) -> DataFrame:
    """The rows that :func:`snow_fact` gives, read from a star fact that has the column :data:`SHIFTS`: nothing is moved or stored."""
    for step in snow_steps(both.columns):
        both = both.selectExpr(*step)
    return both


def snow_steps(columns: Sequence[str]) -> list[list[str]]:
    """:func:`snow_view` as lists of SQL expressions, for a fact of these columns."""
    sk, _ = NATURAL_KEYS["dim_producto"]
    columns = [c for c in columns if c != SHIFTS]
    return [[*columns, f"explode({SHIFTS}) AS _shift"], [f"{sk} + _shift AS {sk}" if c == sk else c for c in columns]]


def products_with_family(snow: Mapping[str, DataFrame]) -> DataFrame:
    """Two-hop product dimension: product and the family it belongs to."""
    return snow["dim_producto"].join(snow["dim_familia_producto"], "familia_sk")
