"""The load as one job: everything or nothing, once."""

import pytest
from pyspark.sql import functions as F

from starfold.catalog.loads import first_load, second_load
from starfold.catalog.registry import Source
from starfold.plans.load import CHANGING, FACT, QUARTERLY, REJECTS, apply_increment, publish_models
from starfold.sinks import Load, VersionedLayer


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return Source(spark, sf_dir)


@pytest.fixture(scope="module")
def begun(spark, source, tmp_path_factory):
    layer = VersionedLayer(spark, str(tmp_path_factory.mktemp("layer") / "models"))
    publish_models(layer, "first", *first_load(source))
    return layer


def counts(layer, version=None):
    return {name: layer.read(name, version).count() for name in sorted(layer.tables(version))}


def test_a_failed_load_leaves_everything_as_it_was(source, begun, monkeypatch):
    version, before = begun.current(), counts(begun)

    def boom(self):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(Load, "commit", boom)
    with pytest.raises(RuntimeError):
        apply_increment(begun, "second", second_load(source), source.warehouse.oltp)
    monkeypatch.undo()
    assert begun.current() == version and counts(begun) == before
    after = apply_increment(begun, "second", second_load(source), source.warehouse.oltp)
    assert after == version + 1 and counts(begun, version) == before
    star = source.warehouse.star[FACT]
    for model in ("star", "snow"):
        fact = begun.read(f"{model}.{FACT}")
        assert fact.count() == star.count() and fact.select("detalle_id").distinct().count() == star.select("detalle_id").distinct().count()
    assert begun.read("star.dim_tiempo").count() == source.warehouse.star["dim_tiempo"].count() == begun.read("snow.dim_tiempo").count()
    for name in CHANGING:
        assert begun.read(f"oltp.{name}").count() == source.warehouse.oltp[name].count(), name
    assert begun.read(REJECTS).count() == 0


def test_a_repeated_load_changes_nothing(source, begun):
    apply_increment(begun, "second", second_load(source), source.warehouse.oltp)
    version, before = begun.current(), counts(begun)
    assert apply_increment(begun, "second", second_load(source), source.warehouse.oltp) == version
    changes = second_load(source)
    changes["pedidos"] = changes["pedidos"].unionByName(changes["pedidos"])
    assert apply_increment(begun, "again", changes, source.warehouse.oltp) == version + 1
    assert counts(begun) == before
    assert QUARTERLY.refresh_layer(begun) == "current" and begun.current() == version + 1


def test_the_aggregate_reads_only_missing_loads(spark, source, begun):
    load = begun.load()
    known = load.note(QUARTERLY.name)["loads"]
    assert known == load.loads(f"star.{FACT}")
    expected = sorted(map(str, begun.read(QUARTERLY.name).collect()))
    extra = load.read(f"star.{FACT}").filter("detalle_id % 7 = 0").withColumn("detalle_id", F.col("detalle_id") + 10**9)
    load.append(f"star.{FACT}", extra)
    asked = []
    read = load.read
    load.read = lambda table, loads=None: asked.append((table, loads)) or read(table, loads)
    assert QUARTERLY.refresh(load) == "incremental"
    assert [loads for table, loads in asked if table == f"star.{FACT}"] == [load.loads(f"star.{FACT}")[len(known):]]
    grown = sorted(map(str, load.read(QUARTERLY.name).collect()))
    assert QUARTERLY.refresh(load, "full") == "full" and sorted(map(str, load.read(QUARTERLY.name).collect())) == grown != expected
    load.replace(f"star.{FACT}", begun.read(f"star.{FACT}"), ["anio_pedido"])
    assert QUARTERLY.refresh(load) == "full", "a rebuilt table has none of the loads held"
    assert sorted(map(str, load.read(QUARTERLY.name).collect())) == expected
    with pytest.raises(ValueError):
        QUARTERLY.refresh(load, "some")


def test_lines_before_their_order_and_costs(spark, source, tmp_path):
    """Lines wait in the order tables and in the reject log until what they need has come."""
    layer = VersionedLayer(spark, str(tmp_path / "models"))
    oltp, star, snow = first_load(source)
    publish_models(layer, "first", oltp, star, snow)
    base = layer.read(f"star.{FACT}").count()
    every = second_load(source)
    order = source.warehouse.oltp["pedidos"].filter("fecha_pedido >= '2000-01-01'").agg(F.min("pedido_id")).first()[0]
    own = {n: every[n].filter(F.col("pedido_id") == order) for n in ("pedidos", "detalle_pedido", "envios")}
    costs = every["costes_logisticos"].filter(F.col("envio_id") == order)
    lines = own["detalle_pedido"].distinct().count()
    apply_increment(layer, "lines", {"detalle_pedido": own["detalle_pedido"]}, source.warehouse.oltp)
    assert layer.read(f"star.{FACT}").count() == base and layer.read(REJECTS).count() == lines
    apply_increment(layer, "order", {"pedidos": own["pedidos"], "envios": own["envios"]}, source.warehouse.oltp)
    assert layer.read(f"star.{FACT}").count() == base
    apply_increment(layer, "costs", {"costes_logisticos": costs}, source.warehouse.oltp)
    assert layer.read(f"star.{FACT}").count() == base + lines == layer.read(f"snow.{FACT}").count()
    assert {r.load_id for r in layer.read(REJECTS).collect()} == {"lines", "order"}
    apply_increment(layer, "nothing", {}, source.warehouse.oltp)
    assert layer.read(f"star.{FACT}").count() == base + lines
