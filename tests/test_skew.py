"""One order and one lot hold a third of all lines each, and nothing may be broadcast."""

import shutil
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F

from starfold.catalog import ORACLES, QUERIES
from starfold.plans.retail import warehouse

CHECKED = ["a1_oltp", "a2_star", "a3_snow", "a4_oltp", "a5_star", "d9_star_fact", "d13_snow_fact", "d14_increment",
           "a6_incremental_refresh", "t9_shipments", "j9_lookup_first", "j10_orphans", "g8_dedup_keep_first", "w1_top1_per_group"]


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for path in Path(sf_dir).glob("*.parquet"):
        if path.name != "lineitem.parquet":
            shutil.copy(path, folder / path.name)
    third = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"), F.lit(3))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.withColumns({
        "l_partkey": F.when(third == 0, F.lit(7).cast("bigint")).otherwise(F.col("l_partkey")),
        "l_orderkey": F.when(third == 1, F.lit(5).cast("bigint")).otherwise(F.col("l_orderkey")),
    }).toPandas().to_parquet(folder / "lineitem.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_keys_are_found(spark, skewed_dir, no_broadcast):
    hot = warehouse(spark, skewed_dir).hot_join_keys()
    eight, six = spark.range(1).select(F.xxhash64(F.lit(8).cast("bigint")), F.xxhash64(F.lit(6).cast("bigint"))).first()
    assert hot["lote_id"] == [eight] and hot["pedido_id"] == [six]


@pytest.mark.parametrize("name", CHECKED)
def test_results_stay_whole(spark, skewed_dir, no_broadcast, name):
    con = oracle.connect(skewed_dir)
    assert oracle.difference(QUERIES[name](spark, skewed_dir), con, ORACLES[name]) is None
