"""The load as one job: order tables, both models and the stored aggregate, published together."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import distinct_rows, is_small, sized_join, skew_join
from ..operators.upsert import one_per_key
from ..session import written
from ..sinks.versions import Load, VersionedLayer
from .aggregates import StoredAggregate
from .increment import not_loaded, resolved
from .questions import aggregate_lines, build_aggregate, refresh_aggregate
from .snow import SHIFTS, product_shifts, snow_fact, snow_steps
from .star import Tables

#: Tables that a load adds rows to, with the key that tells known rows.
CHANGING = {"pedidos": "pedido_id", "detalle_pedido": "detalle_id", "envios": "envio_id", "costes_logisticos": "envio_id"}
#: Source lines may share an identifier; of them only whole repeats are one.
SHARED = ("detalle_pedido",)
FACT, CALENDAR, REJECTS = "fact_exportaciones", "dim_tiempo", "rechazos.detalle_pedido"


class _Model(Mapping):
    """The tables of one model (``oltp``, ``star`` or ``snow``) as a load sees them."""

    def __init__(self, load: Load, model: str, names: list[str]):
        self._load, self._model, self._names = load, model, names

    def __getitem__(self, name: str) -> DataFrame:
        return self._load.read(f"{self._model}.{name}")

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _model(load: Load, model: str) -> _Model:
    prefix = f"{model}."
    return _Model(load, model, [t.removeprefix(prefix) for t in load.names() if t.startswith(prefix)])


#: Revenue by quarter over the star model.
QUARTERLY = StoredAggregate(
    "star.ingresos_trimestre", f"star.{FACT}", lambda load, rows: build_aggregate(_model(load, "star"), rows), refresh_aggregate,
    lambda load, rows: aggregate_lines(_model(load, "star"), rows))


def publish_models(layer: VersionedLayer, load_id: str, oltp: Tables, star: Tables, snow: Tables) -> int:
    """First load: the changing tables of ``oltp``, both models whole, and the aggregate.

    A star fact that has the column :data:`SHIFTS` serves both models: it is stored once, and the
    snowflake's fact reads its files.
    """
    load = layer.load(load_id)
    if load.applied:
        return load.base
    for name in CHANGING:
        load.replace(f"oltp.{name}", oltp[name])
    for model, tables in (("star", star), ("snow", snow)):
        for name in tables:
            if name != FACT:
                load.replace(f"{model}.{name}", tables[name])
    both = SHIFTS in star[FACT].columns
    # A fact is stored by year already.
    load.replace(f"star.{FACT}", star[FACT], ["anio_pedido"], gather=False, beside=[SHIFTS] if both else [])
    if both:
        _share_fact(load, load.loads(f"star.{FACT}"))
    else:
        load.replace(f"snow.{FACT}", snow[FACT], ["anio_pedido"], gather=False)
    QUARTERLY.refresh(load)
    return load.commit()


def _share_fact(load: Load, loads: list[str]) -> None:
    """Make ``loads`` of the star's fact the snowflake's, whose product keys are stored beside it."""
    stored = load.read(f"star.{FACT}").withColumn(SHIFTS, F.lit(None).cast("array<bigint>"))
    load.share(f"snow.{FACT}", f"star.{FACT}", stored.schema, snow_steps(stored.columns), loads)


def _between(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` in the range of ``keys``: pushed to the scan, it keeps the work near the load."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    return df.limit(0) if low is None else df.filter(F.col(key).between(low, high))


def _unknown(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose key is not stored, and those without a key; whole rows are moved only if many are new."""
    keys = batch.filter(F.col(key).isNotNull()).select(key).distinct()
    new = written(sized_join(keys, distinct_rows(_between(stored, key, batch).select(key)), key, "left_anti"), "load-keys")
    rows = skew_join(batch, new, key, "left_semi").select(*batch.columns)
    return rows.unionByName(batch.filter(F.col(key).isNull()))


def apply_increment(layer: VersionedLayer, load_id: str, changes: Tables, masters: Tables) -> int:
    """Load ``changes`` (rows of any of :data:`CHANGING`) and publish all they lead to as one version; its number.

    Rows whose key is stored already are skipped, so a batch may overlap former ones, and
    repeated rows of a batch count once. The orders touched are those of new orders,
    lines, shipments and costs: whatever lines of theirs the fact lacks are loaded, late
    lines of known orders and lines that waited for their order included. The changes are
    read several times, so hand over stored rows rather than a long plan. Both
    calendars grow by the orders' dates, both facts and the aggregate by the lines.
    Lines that no order, shipment, cost or dimension knows are logged. ``masters`` are
    the tables a load does not change. A ``load_id`` that is applied changes nothing, and
    a load that fails anywhere leaves the former version as it was.
    """
    load = layer.load(load_id)
    if load.applied:
        return load.base
    fresh, former = {}, {}
    for name, key in CHANGING.items():
        stored = former[name] = load.read(f"oltp.{name}")
        if name in changes:
            rows = _unknown(changes[name].select(*stored.columns), stored, key)
            rows = rows.distinct() if name in SHARED else one_per_key(rows, [key], stored.columns)
            fresh[name] = load.append(f"oltp.{name}", rows)
        else:
            fresh[name] = stored.limit(0)
    t = {**masters, **{name: load.read(f"oltp.{name}") for name in CHANGING}}
    shipped = _between(t["envios"], "envio_id", fresh["costes_logisticos"])
    shipped = sized_join(shipped, fresh["costes_logisticos"].select("envio_id"), "envio_id", "left_semi")
    ids = [fresh[name].select("pedido_id") for name in ("pedidos", "detalle_pedido", "envios")] + [shipped.select("pedido_id")]
    touched = written(ids[0].union(ids[1]).union(ids[2]).union(ids[3]).distinct(), "load-touched")
    of_orders = lambda df: skew_join(_between(df, "pedido_id", touched), touched, "pedido_id", "left_semi").select(*df.columns)
    orders = written(of_orders(t["pedidos"]), "load-orders")
    t["pedidos"], t["envios"] = orders, written(of_orders(t["envios"]), "load-shipments")
    t["costes_logisticos"] = _between(t["costes_logisticos"], "envio_id", t["envios"])

    star, snow = _model(load, "star"), _model(load, "snow")
    # Of the stored lines few wait as a rule, and of the fresh ones few are loaded: they are told by their identifiers.
    facts = _between(star[FACT], "pedido_id", touched)
    waiting = written(of_orders(not_loaded(_between(former["detalle_pedido"], "pedido_id", touched), facts)), "load-waiting")
    pending = waiting.unionByName(not_loaded(fresh["detalle_pedido"].filter("pedido_id IS NOT NULL"), facts, mostly=True))
    both = load.shares(f"snow.{FACT}")
    days, rows = resolved(t, star, orders, pending, product_shifts(star, snow) if both else None)
    days = load.append(f"star.{CALENDAR}", days)
    load.append(f"snow.{CALENDAR}", days)  # a conformed dimension: the same keys
    beside, known = [SHIFTS] if both else [], load.loads(f"star.{FACT}")
    lines = load.append(f"star.{FACT}", rows.select(*star[FACT].columns, *beside), gather=is_small(orders), beside=beside)
    if both:
        _share_fact(load, [*load.loads(f"snow.{FACT}"), *load.loads(f"star.{FACT}")[len(known):]])
    else:
        load.append(f"snow.{FACT}", snow_fact(lines, star, snow).select(*snow[FACT].columns), gather=False)
    QUARTERLY.refresh(load)
    left = not_loaded(pending, lines)
    load.append(REJECTS, left.withColumn("load_id", F.lit(load_id)))
    return load.commit()
