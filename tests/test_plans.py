"""The physical plans are the intended ones."""

import re

import pytest
from pyspark.sql import functions as F

from starfold.operators.dedup import top1_per_group
from starfold.operators.lookup import lookup
from starfold.plans.questions import QUESTIONS, ask_oltp, ask_star
from starfold.plans.retail import warehouse
from starfold.sources.tables import read_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem")


def test_filter_and_columns_reach_the_scan(lines):
    text = plan(lines.filter(F.col("l_shipdate").between("1998-01-01", "1998-12-31")).select("l_orderkey"))
    assert "GreaterThanOrEqual(l_shipdate" in text and "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp" in text


def test_top1_is_limited_before_the_shuffle(lines):
    text = plan(top1_per_group(lines, ["l_partkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"]))
    assert re.search(r"WindowGroupLimit.*Final", text) and re.search(r"WindowGroupLimit.*Partial", text)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_star_question_shuffles_once(spark, sf_dir):
    text = plan(ask_star(warehouse(spark, sf_dir).star, QUESTIONS["a5"]))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_fact_scan_reads_only_what_a_question_needs(spark, sf_dir):
    text = plan(ask_star(warehouse(spark, sf_dir).star, QUESTIONS["a7"]))
    fact_scan = next(s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "margen" in s)
    assert {c.split(":")[0] for c in fact_scan.split(",") if ":" in c} == {"producto_sk", "importe_neto", "coste_total", "margen"}


def test_fact_is_pruned_by_year(spark, sf_dir):
    fact = warehouse(spark, sf_dir).star["fact_exportaciones"]
    assert "PartitionFilters: [isnotnull(anio_pedido" in plan(fact.filter("anio_pedido = 1998").select("margen"))


def test_lookup_is_a_broadcast_only_when_small(spark, lines, sf_dir):
    part = read_table(spark, sf_dir, "part")
    small = lookup(lines.select("l_partkey"), part, {"l_partkey": "p_partkey"}, {"p_size": ("size", 0)})
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup(lines.select("l_partkey"), part, {"l_partkey": "p_partkey"}, {"p_size": ("size", 0)})
        assert "SortMergeJoin" in plan(large) and "_salt" in plan(large)
        assert large.exceptAll(small).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_large_dimensions_are_joined_after_aggregation(spark, sf_dir):
    star = warehouse(spark, sf_dir).star
    expected = ask_star(star, QUESTIONS["a2"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        answer = ask_star(star, QUESTIONS["a2"])
        text = plan(answer)
        assert text.count("HashAggregate") >= 4 and "BroadcastHashJoin" not in text
        assert answer.exceptAll(expected).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


def test_no_python_in_any_plan(spark, sf_dir):
    from starfold.catalog import QUERIES

    for name in ("a1_oltp", "d16_weather_clean", "f7_canonicalise", "t4_split", "u1_upsert"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text and "MapInPandas" not in text, name


def test_three_models_are_reconciled_in_one_shuffle(spark, sf_dir):
    from starfold.catalog.questions import _MEASURES, lines_of_models
    from starfold.catalog.registry import Source
    from starfold.operators.reconcile import reconcile_many

    text = plan(reconcile_many(lines_of_models(Source(spark, sf_dir)), QUESTIONS["a1"].keys, _MEASURES))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_order_questions_read_stored_halves(spark, sf_dir):
    """Lines meet two stored halves of which only the columns asked for are read, and are shuffled only when grouped."""
    w = warehouse(spark, sf_dir)
    for name in ("a1", "a2", "a3", "a4", "a5"):
        narrow = ask_oltp(w.oltp, QUESTIONS[name], w.hot_join_keys())
        stored = ask_oltp(w.oltp, QUESTIONS[name], w.hot_join_keys(), w.chain)
        text = plan(stored)
        assert text.count("FileScan") == 3 and text.count("Exchange hashpartitioning") == 1, name
        assert stored.exceptAll(narrow).count() == 0 == narrow.exceptAll(stored).count(), name
    assert "nombre_cliente" not in re.sub(r"ReadSchema: [^\n]*detalle[^\n]*", "", plan(ask_oltp(w.oltp, QUESTIONS["a2"], w.hot_join_keys(), w.chain)))


def test_a_chain_of_lots_is_not_broadcast_near_the_limit(spark):
    """Sides that Spark would broadcast one by one are shuffled when each takes a large share of the limit."""
    from starfold.operators.joins import broadcast_limit, estimated_bytes, lean_join

    side = spark.range(100).selectExpr("id AS k", "id AS v")
    size, limit = estimated_bytes(side), broadcast_limit(side)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size))
        near = lean_join(spark.range(1000).selectExpr("id AS k"), side, "k")
        assert "BroadcastHashJoin" not in near._jdf.queryExecution().executedPlan().toString() and near.count() == 100
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(8 * size))
        far = lean_join(spark.range(1000).selectExpr("id AS k"), side, "k")
        assert "BroadcastHashJoin" in far._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
