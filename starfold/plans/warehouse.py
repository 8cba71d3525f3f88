"""A warehouse: OLTP tables and the star and snowflake layers built from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import hot_keys, is_small
from ..schemas import FINANCE, LOGISTICS, PRODUCTION, QUALITY, SALES, SNOW, STAR
from ..session import CODEC, scratch_path, written
from ..sinks.append import write_partitioned
from ..sinks.databases import save_database
from . import snow as snow_plans
from . import star as star_plans
from .derive import served_lines
from .questions import chain


class LazyTables(Mapping):
    """Tables built on first use; those in ``stored`` are written once and read back."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], stored: Callable[[str], bool], layer: str):
        self._builders = dict(builders)
        self._stored = stored
        self._layer = layer
        self._built: dict[str, DataFrame] = {}
        self._locks: dict[str, Lock] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks.setdefault(name, Lock()):
            if name not in self._built:
                df = self._builders[name]()
                self._built[name] = written(df, f"{self._layer}-{name}", CODEC) if self._stored(name) else df
            return self._built[name]

    def build(self, names: Sequence[str], at_once: int = 4) -> None:
        """Build several tables, ``at_once`` of them as concurrent Spark jobs."""
        with ThreadPoolExecutor(at_once) as pool:
            for done in [pool.submit(self.__getitem__, name) for name in names]:
                done.result()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def define(self, name: str, builder: Callable[[], DataFrame]) -> None:
        self._builders[name] = builder


def write_fact(spark: SparkSession, fact: DataFrame, label: str, gather: bool = True) -> DataFrame:
    """Write a fact partitioned by year, so that loads and slices touch few files (``gather``: see :func:`write_partitioned`)."""
    path = scratch_path(spark, label)
    write_partitioned(fact, path, ["anio_pedido"], gather=gather)
    return spark.read.schema(fact.schema).parquet(path)  # also when it has no rows


class Warehouse:
    """``oltp`` gives the builders of the OLTP tables, ``stored`` those worth writing once."""

    def __init__(
        self,
        spark: SparkSession,
        oltp: Callable[[Mapping[str, DataFrame]], Mapping[str, Callable[[], DataFrame]]],
        stored: Sequence[str] = (),
        catalog: star_plans.Catalog = star_plans.Catalog(),
    ):
        self.spark = spark
        self.oltp = LazyTables({}, lambda name: name in stored, "oltp")
        for name, builder in oltp(self.oltp).items():
            self.oltp.define(name, builder)
        self.star = LazyTables(star_plans.dimensions(self.oltp, catalog), lambda n: n.startswith("dim_"), "star")
        self._facts = LazyTables({"fact_exportaciones": self._both_facts}, lambda name: False, "facts")
        self.star.define("fact_exportaciones", self._star_fact)
        self.snow = LazyTables({}, lambda n: n in ("dim_producto", "dim_familia_producto"), "snow")
        for name, builder in snow_plans.dimensions(self.star, self.snow).items():
            self.snow.define(name, builder)
        self.snow.define("fact_exportaciones", self._snow_fact)
        self.chain = LazyTables(chain(self.oltp, self.hot_join_keys), lambda name: True, "chain")
        self._hot: dict[str, list[int]] | None = None

    def _both_facts(self) -> DataFrame:
        """The fact of both models, stored once: lines beyond a broadcast of their orders are written by the tasks that join them."""
        self.star.build([n for n in self.star if n.startswith("dim_")])
        self.snow.build(["dim_familia_producto", "dim_producto"])
        fact = star_plans.star_fact(self.oltp, self.star, snow_plans.product_shifts(self.star, self.snow))
        return write_fact(self.spark, fact, "fact", gather=is_small(self.oltp["pedidos"]))

    @property
    def fact_of_both(self) -> DataFrame:
        """The stored fact with the column :data:`starfold.plans.snow.SHIFTS`."""
        return self._facts["fact_exportaciones"]

    def _star_fact(self) -> DataFrame:
        return self.fact_of_both.drop(snow_plans.SHIFTS)

    def _snow_fact(self) -> DataFrame:
        return snow_plans.snow_view(self.fact_of_both)

    def hot_join_keys(self) -> dict[str, list[int]]:
        """Lots, orders, customers and routes holding a large share of the rows that refer to them.

        Looked up once. Tables small enough to be broadcast cannot be a hot spot and are not scanned.
        """
        if self._hot is None:
            # Key column -> table whose rows refer to it.
            holders = {"lote_id": "detalle_pedido", "pedido_id": "detalle_pedido", "cliente_id": "pedidos", "ruta_id": "envios"}
            self._hot = {
                key: [] if is_small(self.oltp[name]) else hot_keys(self.oltp[name], [key]) for key, name in holders.items()}
        return self._hot

    def served(self, tables: Mapping[str, DataFrame], name: str) -> DataFrame:
        """A table with all its declared columns."""
        return served_lines(tables) if name == "detalle_pedido" else tables[name]

    def save(self, path: str, names: Mapping[str, Sequence[str]] | None = None) -> None:
        """Save the layers as databases under ``path``; ``names`` limits it to some tables of each.

        Existing SQL then runs over ``olap_star.fact_exportaciones``, ``oltp_ventas.pedidos`` and so on.
        """
        for database, (tables, declared) in {
            "oltp_produccion": (self.oltp, PRODUCTION), "oltp_calidad": (self.oltp, QUALITY), "oltp_ventas": (self.oltp, SALES),
            "oltp_logistica": (self.oltp, LOGISTICS), "oltp_finanzas": (self.oltp, FINANCE),
            "olap_star": (self.star, STAR), "olap_snow": (self.snow, SNOW),
        }.items():
            wanted = [n for n in declared if names is None or n in names.get(database, ())]
            if wanted:
                save_database(self.spark, database, f"{path}/{database}", {n: self.served(tables, n) for n in wanted},
                              partition_by={"fact_exportaciones": ["anio_pedido"]})
