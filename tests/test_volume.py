"""Large tables are moved and stored no more often than they have to be."""

import pytest
from pyspark.sql import functions as F

from starfold.catalog import QUERIES
from starfold.operators.lookup import key_map, rekey
from starfold.plans.retail import warehouse
from starfold.plans.snow import SHIFTS, product_shifts, snow_view
from starfold.sinks import write_partitioned

FACT = "fact_exportaciones"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_layer_violations_are_joined_in_jobs_of_their_own(spark, sf_dir):
    """The answer reads stored reports: no plan holds the broadcasts of all rules at once."""
    report = QUERIES["q_layer_violations"](spark, sf_dir)
    text = plan(report)
    assert "Broadcast" not in text and "Join" not in text and "Exchange" not in text
    assert {(r.capa, r.tabla, r.rule) for r in report.select("capa", "tabla", "rule").distinct().collect()} <= {
        ("oltp", "clientes", "domain:segmento"), ("oltp", "detalle_pedido", "unique:detalle_id")}


def test_both_models_read_one_stored_fact(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    star, snow = w.star[FACT], w.snow[FACT]
    assert sorted(star.inputFiles()) == sorted(snow.inputFiles()) and SHIFTS not in star.columns + snow.columns
    assert "Exchange" not in plan(snow) and "Join" not in plan(snow) and star.columns == snow.columns
    assert "PartitionFilters: [isnotnull(anio_pedido" in plan(snow.filter("anio_pedido = 1998").select("margen"))


@pytest.mark.parametrize("snow_products", [
    [(1, 10), (2, 20), (3, 30)], [(1, 20), (2, 30)], [(1, 10), (2, 10), (3, 20), (4, 20), (5, 30)], []])
def test_the_view_is_the_rekeyed_fact(spark, snow_products):
    """Also when products are missing (no family) or their natural keys repeat."""
    columns = "producto_sk bigint, cultivo_id bigint"
    star = {"dim_producto": spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], columns)}
    snow = {"dim_producto": spark.createDataFrame(snow_products, columns)}
    fact = spark.range(40).select("id", (F.col("id") % 4 + 1).alias("producto_sk"), (F.col("id") * 3).alias("margen"))
    expected = rekey(fact, {"producto_sk": key_map(star["dim_producto"], snow["dim_producto"], "producto_sk", ["cultivo_id"])})
    got = snow_view(fact.join(product_shifts(star, snow), "producto_sk", "left").select(*fact.columns, SHIFTS))
    assert got.columns == expected.columns and sorted(got.collect()) == sorted(expected.collect())


def test_rows_are_written_where_they_are(spark, tmp_path):
    rows = spark.range(0, 400, 1, 4).select("id", (F.col("id") % 2).alias("p"))
    write_partitioned(rows, str(tmp_path / "there"), ["p"], gather=False)
    there = spark.read.parquet(str(tmp_path / "there"))
    assert there.count() == 400 and len(there.inputFiles()) == 8


def test_snow_products_are_stored_before_a_fact_meets_them(spark, sf_dir):
    """Catalyst multiplies the sizes of products and families; what is stored is broadcast by its true size."""
    from starfold.plans.questions import QUESTIONS, ask_snow

    text = plan(ask_snow(warehouse(spark, sf_dir).snow, QUESTIONS["a2"]))
    assert "familia_sk" not in text and text.count("Exchange hashpartitioning") == 1
