"""Tables whose files are far smaller than their rows are not broadcast: a broadcast is built on the driver."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from starfold.operators.joins import estimated_bytes, is_small, memory_bytes, sized_join, skew_join
from starfold.plans.questions import QUESTIONS, ask_dimensional
from starfold.plans.star import farm_dim, lot_keys

LIMIT = "spark.sql.autoBroadcastJoinThreshold"


@contextmanager
def limit_of(spark, size):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, str(size))
    try:
        yield
    finally:
        spark.conf.set(LIMIT, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def keys(spark, tmp_path_factory):
    """60000 keys, dense and packed: some 20 times less in files than in memory."""
    path = str(tmp_path_factory.mktemp("packed") / "keys")
    spark.range(60_000).select("id", (F.col("id") + 1).alias("sk"), F.lit("a family").alias("name")).coalesce(1).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def test_what_is_small_in_files_only_is_not_broadcast(spark, keys):
    rows = spark.range(0, 200, 1, 2).withColumnRenamed("id", "n").withColumn("id", F.col("n") * 7)
    side, big = keys.select("id", "sk"), keys.select("id", F.col("sk").alias("other"))
    with limit_of(spark, estimated_bytes(side) + 1000):
        assert memory_bytes(side) > 4 * estimated_bytes(side) + 4000 and not is_small(side)
        for how in ("inner", "left", "left_anti", "left_semi"):
            many = rows.union(spark.range(1).select(F.lit(9), F.lit(None).cast("bigint")))
            for joined in (skew_join(many.repartition(2), side, "id", how), sized_join(many.repartition(2), side, "id", how)):
                assert "BroadcastHashJoin" not in plan(joined)
                assert joined.count() == {"inner": 200, "left": 201, "left_anti": 1, "left_semi": 200}[how]
        # The other side may be the one that Spark would pick.
        few = spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "id bigint, n int")
        for joined in (skew_join(big, few, "id"), sized_join(big, few, "id"), sized_join(few, big, "id")):
            assert sorted(r.other for r in joined.collect()) == [8, 8]
        assert "BuildLeft" not in plan(sized_join(big, few, "id"))


def test_no_rows_are_counted_for_tiny_tables_or_without_broadcasts(spark, keys):
    with limit_of(spark, -1):
        assert not is_small(keys.limit(3))
    with limit_of(spark, 300 * estimated_bytes(keys)):
        assert is_small(keys)


def test_a_dimension_small_in_files_only_is_not_broadcast_to_the_fact(spark, keys):
    fact = spark.range(0, 3000, 1, 2).select(
        (F.col("id") % 50 + 1).alias("producto_sk"), F.lit(2).cast("decimal(12,2)").alias("importe_neto"),
        F.lit(1).cast("decimal(12,2)").alias("coste_total"), F.lit(1).cast("decimal(12,2)").alias("margen"))
    products = keys.select(F.col("sk").alias("producto_sk"), F.col("name").alias("familia_producto"))
    with limit_of(spark, estimated_bytes(products) + 1000):
        answer = ask_dimensional(fact, {"dim_producto": products}, QUESTIONS["a7"])
        assert "BroadcastHashJoin" not in plan(answer)
        assert [tuple(map(str, r)) for r in answer.collect()] == [("a family", "6000.00", "3000.00", "3000.00")]


def test_keys_of_lots_are_resolved_without_large_broadcasts(spark, keys, tmp_path):
    """All lookups of a lot's chain, with repeated and null keys."""
    n = F.col("id")
    def stored(name, *columns):
        keys.select(*columns).write.option("compression", "zstd").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    product = F.when(n % 100 != 5, n)
    t = {"lotes_origen": stored("lotes", n.alias("lote_id"), n.alias("cosecha_id")),
         "costes_lote": stored("costes", n.alias("lote_id"), F.lit(1).cast("decimal(10,4)").alias("coste_por_kg")),
         "cosechas": stored("cosechas", n.alias("cosecha_id"), n.alias("parcela_id"), product.alias("cultivo_id"), (n % 2).alias("campania_id")),
         "parcelas": stored("parcelas", n.alias("parcela_id"), n.alias("finca_id"), F.lit("p").alias("nombre_parcela"))}
    twice = F.explode(F.when(n == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    dims = {"dim_producto": stored("producto", "sk", n.alias("cultivo_id"), twice.alias("_n")).select(F.col("sk").alias("producto_sk"), "cultivo_id"),
            "dim_finca": stored("finca", F.col("sk").alias("finca_sk"), n.alias("finca_id"), F.lit("p").alias("parcela")),
            "dim_calidad": stored("calidad", F.col("sk").alias("calidad_sk"), n.alias("lote_id")),
            "dim_campania": spark.createDataFrame([(1, 0), (2, 1)], "campania_sk bigint, campania_id bigint")}
    with limit_of(spark, 200_000):
        lots = lot_keys(t, dims)
        # Campaigns may be broadcast; no table of 60000 rows.
        assert plan(lots).count("BroadcastHashJoin") <= 1
        assert lots.count() == 60_000 - 600 + 1
        assert lots.filter("lote_id = 7 AND producto_sk = 8 AND finca_sk = 8 AND calidad_sk = 8 AND campania_sk = 2").count() == 2


def test_plots_are_not_broadcast_for_the_farms(spark, keys):
    n = F.col("id")
    plots = keys.select(n.alias("parcela_id"), n.alias("finca_id"), F.concat(F.lit("Parcela_"), n).alias("nombre_parcela"),
                        F.lit(1).cast("decimal(8,2)").alias("superficie_hectareas"), F.lit("varios").alias("cultivo_actual"))
    farms = keys.select(n.alias("finca_id"), *[F.lit(c).alias(c) for c in ("nombre_finca", "municipio", "provincia", "zona_agricola", "tipo_suelo", "sistema_riego")])
    with limit_of(spark, 3 * estimated_bytes(keys)):
        seen = []
        import starfold.plans.star as star
        number, star.number_dimension = star.number_dimension, lambda rows, *a: seen.append(rows) or number(rows, *a)
        try:
            dim = farm_dim(plots, farms)
        finally:
            star.number_dimension = number
        assert "BroadcastHashJoin" not in plan(seen[0]) and dim.count() == 60_000
