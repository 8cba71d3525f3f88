"""Incremental load of new orders into an existing dimensional model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import distinct_rows, is_small, sized_join, skew_join
from ..operators.keys import assign_sk
from ..operators.upsert import absent_rows
from ..session import written
from .star import calendar_rows, star_fact

Tables = Mapping[str, DataFrame]


def extend_calendar(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    """Calendar rows for order dates it lacks, numbered after the existing ones."""
    fresh = absent_rows(calendar, calendar_rows(orders), ["fecha"])
    highest = calendar.agg(F.max("tiempo_sk")).first()[0] or 0
    return assign_sk(fresh, "tiempo_sk", ["fecha"], start=highest + 1, bounded=True).select(*calendar.columns)


def new_lines(lines: DataFrame, orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines of ``orders`` that the fact does not hold: this makes a repeated load harmless and lets late lines in.

    Only the years the orders fall in are read from the fact, and only the range of
    their numbers from the lines. The orders' numbers are written first, so that a small
    load is seen to be small and the lines stay where they are. Numbers alone tell which
    lines are new: a load of known lines moves none of them.
    """
    ids = written(orders.select("pedido_id"), "load-orders")
    low, high = ids.agg(F.min("pedido_id"), F.max("pedido_id")).first()
    if low is None:
        return lines.limit(0)
    first, last = orders.agg(F.year(F.min("fecha_pedido")), F.year(F.max("fecha_pedido"))).first()
    near, numbers, without = lines.filter(F.col("pedido_id").between(low, high)), ["pedido_id", "detalle_id"], F.col("detalle_id").isNull()
    own = skew_join(near.filter(~without).select(*numbers), ids, "pedido_id", "left_semi").distinct()
    loaded = fact.filter(F.col("anio_pedido").between(first, last) & F.col("pedido_id").between(low, high))
    new = written(sized_join(own, distinct_rows(loaded.select("detalle_id")), "detalle_id", "left_anti"), "load-new")
    parts = skew_join(near, new, numbers, "left_semi"), skew_join(near.filter(without), ids, "pedido_id", "left_semi")
    return parts[0].select(*lines.columns).unionByName(parts[1].select(*lines.columns))


def increment(t: Tables, dims: Tables, fact: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calendar rows, fact rows) to append for ``orders``.

    The rows are to be appended together as one version of the layer. All other
    dimensions are reused; a line whose lot, customer or route they do not know
    is left out, as in the full load (:func:`unresolved_lines` lists them). Orders
    and lots that the new lines do not touch are left alone, so the work follows the load.
    """
    pending = written(new_lines(t["detalle_pedido"], orders, fact), "load-lines")
    calendar, rows = resolved(t, dims, orders, pending)
    return calendar, rows.select(*fact.columns)


def resolved(t: Tables, dims: Tables, orders: DataFrame, pending: DataFrame, of_products: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(calendar rows that ``orders`` add, fact rows of the lines ``pending``, which are read several times)."""
    calendar = extend_calendar(dims["dim_tiempo"], orders)  # dates of orders without lines, too
    grown = {**{name: dims[name] for name in dims}, "dim_tiempo": dims["dim_tiempo"].unionByName(calendar)}
    slice_ = {**{name: t[name] for name in t}, "pedidos": orders, "detalle_pedido": pending}
    # Few lines touch few orders and lots. Many would be moved once more to find out which, without sparing much.
    if is_small(pending.select("pedido_id", "lote_id")):
        slice_["pedidos"] = orders.join(pending.select("pedido_id").distinct(), "pedido_id", "left_semi").select(*orders.columns)
        slice_["lotes_origen"] = t["lotes_origen"].join(pending.select("lote_id").distinct(), "lote_id", "left_semi")
    return calendar, star_fact(slice_, grown, of_products)


def not_loaded(lines: DataFrame, fact: DataFrame, mostly: bool = False) -> DataFrame:
    """Lines whose identifier ``fact`` lacks, and those without one. ``lines`` is read several times.

    Identifiers alone are compared. Whole lines are moved only if those wanted, or with
    ``mostly`` those not wanted, are more than a broadcast.
    """
    ids = lines.filter("detalle_id IS NOT NULL").select("detalle_id").distinct()
    held = distinct_rows(fact.select("detalle_id"))
    found = written(sized_join(ids, held, "detalle_id", "left_semi" if mostly else "left_anti"), "load-ids")
    if mostly:
        return skew_join(lines, found, "detalle_id", "left_anti").select(*lines.columns)
    wanted = skew_join(lines, found, "detalle_id", "left_semi").select(*lines.columns)
    return wanted.unionByName(lines.filter("detalle_id IS NULL"))


def unresolved_lines(lines: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines that a load left out, since a dimension or an order does not know them: for the reject log."""
    return skew_join(lines, distinct_rows(fact.select("detalle_id")), "detalle_id", "left_anti").select(*lines.columns)
