"""Loads that move identifiers rather than rows, and a fact that both models read."""

import pytest
from pyspark.sql import functions as F

from starfold.catalog.loads import first_load, second_load
from starfold.catalog.registry import Source
from starfold.plans.increment import new_lines, not_loaded
from starfold.plans.load import FACT, QUARTERLY, apply_increment, publish_models
from starfold.plans.snow import SHIFTS, snow_fact
from starfold.sinks import VersionedLayer


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LINES = "detalle_id bigint, pedido_id bigint, nota string"


def test_few_lines_are_found_without_moving_the_others(spark):
    lines = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d"), (3, 2, "e")], LINES)
    fact = spark.createDataFrame([(2, 1, "x"), (2, 1, "y"), (3, 2, "z"), (None, 9, "n")], LINES)
    expected = rows(lines.filter("detalle_id = 1 OR detalle_id IS NULL"))
    for mostly in (False, True):
        found = not_loaded(lines, fact, mostly=mostly)
        assert rows(found) == expected and "Exchange hashpartitioning" not in plan(found)


def test_a_table_shares_the_files_of_another(spark, tmp_path):
    layer = VersionedLayer(spark, str(tmp_path / "layer"))
    load = layer.load()
    assert load.append("t", spark.createDataFrame([(1, 10), (2, 20)], "k int, v int"), beside=["v"]).columns == ["k"]
    view = load.share("u", "t", spark.createDataFrame([], "k int, v int").schema, [["k", "v + 1 AS v"], ["k * 2 AS k", "v"]], load.loads("t"))
    assert rows(view) == rows(spark.createDataFrame([(2, 11), (4, 21)], "k int, v int"))
    with pytest.raises(ValueError):
        load.append("u", view)
    load.commit()
    layer.publish({"t": spark.createDataFrame([(9,)], "k int")})
    layer.retain(1, grace_seconds=-60)
    assert rows(layer.read("u")) == rows(view) and layer.read("t").count() == 1


def test_both_models_of_a_load_read_one_fact(spark, sf_dir, tmp_path):
    source = Source(spark, sf_dir)
    layer = VersionedLayer(spark, str(tmp_path / "models"))
    publish_models(layer, "first", *first_load(source))
    changes = second_load(source)
    changes["detalle_pedido"] = changes["detalle_pedido"].unionByName(changes["detalle_pedido"])  # whole repeats are one
    apply_increment(layer, "second", changes, source.warehouse.oltp)
    star, snow = layer.read(f"star.{FACT}"), layer.read(f"snow.{FACT}")
    assert SHIFTS not in star.columns + snow.columns and sorted(star.inputFiles()) == sorted(snow.inputFiles())
    assert star.select("detalle_id", "margen").exceptAll(source.warehouse.star[FACT].select("detalle_id", "margen")).count() == 0
    assert star.count() == snow.count() == source.warehouse.star[FACT].count()
    dims = [{"dim_producto": layer.read(f"{model}.dim_producto")} for model in ("star", "snow")]
    assert rows(snow) == rows(snow_fact(star, *dims).select(*snow.columns))


def test_models_with_facts_of_their_own_stay_apart(spark, sf_dir, tmp_path):
    source = Source(spark, sf_dir)
    oltp, star, snow = first_load(source)
    layer = VersionedLayer(spark, str(tmp_path / "models"))
    publish_models(layer, "first", oltp, {**star, FACT: star[FACT].drop(SHIFTS)}, snow)
    apply_increment(layer, "second", second_load(source), source.warehouse.oltp)
    one, other = layer.read(f"star.{FACT}"), layer.read(f"snow.{FACT}")
    assert not set(one.inputFiles()) & set(other.inputFiles()) and one.count() == other.count() == source.warehouse.star[FACT].count()


def test_new_lines_are_grouped_once(spark, sf_dir, tmp_path):
    """What an incremental refresh adds to the aggregate are lines, not an aggregate of them."""
    source = Source(spark, sf_dir)
    layer = VersionedLayer(spark, str(tmp_path / "models"))
    publish_models(layer, "first", *first_load(source))
    load = layer.load()
    star = load.read(f"star.{FACT}")
    delta = QUARTERLY.lines(load, star)
    assert "HashAggregate" not in plan(delta) and delta.columns == load.read(QUARTERLY.name).columns
    twice = QUARTERLY.combine(load.read(QUARTERLY.name), delta)
    expected = QUARTERLY.compute(load, star.unionByName(star))
    assert rows(twice) == rows(expected.select(*twice.columns)) and twice.agg(F.count("*")).first()[0] > 0


def test_a_load_of_known_lines_moves_none(spark):
    """Beyond a broadcast, lines that the fact holds are told by their numbers; only those without an identifier meet their orders."""
    orders = spark.range(1, 4001).selectExpr("id AS pedido_id", "DATE'2024-01-05' AS fecha_pedido")
    lines = spark.range(1, 8001).selectExpr("IF(id = 7, NULL, id) AS detalle_id", "id % 5000 + 1 AS pedido_id", "uuid() AS nota")
    fact = lines.selectExpr("detalle_id", "pedido_id", "2024 AS anio_pedido")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")
    try:
        known = new_lines(lines, orders, fact)
        assert plan(known).count("SortMergeJoin") == 1
        assert [r.pedido_id for r in known.collect()] == [8]
        some = new_lines(lines, orders, fact.filter("detalle_id % 2 = 0"))
        assert sorted(r.pedido_id for r in some.collect()) == sorted(
            r.pedido_id for r in lines.filter("pedido_id <= 4000 AND (detalle_id % 2 = 1 OR detalle_id IS NULL)").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_order_lines_are_read_where_they_are_given(spark, sf_dir):
    """A projection of one table is not stored again."""
    lines = Source(spark, sf_dir).warehouse.oltp["detalle_pedido"]
    assert [path.rpartition("/")[2] for path in lines.inputFiles()] == ["lineitem.parquet"]
