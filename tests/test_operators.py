from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starfold.operators import quality
from starfold.operators.dedup import keep_first, top1_per_group
from starfold.operators.joins import hot_keys, salted_join, skew_join
from starfold.operators.keys import assign_sk
from starfold.operators.lookup import key_map, lookup, orphans, rekey, resolve_keys, unresolved
from starfold.operators.reconcile import reconcile
from starfold.operators.reshape import add_constant, expand_list, retype, select_values, unpivot_exprs
from starfold.operators.route import route, tagged
from starfold.operators.upsert import insert_if_absent, upsert
from starfold.sources import inline_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture
def no_broadcast(spark):
    """Everything counts as too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def skewed_lines(spark):
    """A third of the rows share key 7, some have no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100)
    return spark.range(3000).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def side(spark):
    return spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


def hashes(spark, *keys, kind="bigint"):
    """What ``hot_keys`` returns for these keys."""
    return sorted(spark.range(1).select(F.xxhash64(*[F.lit(v).cast(kind) for v in key])).first()[0] for key in keys)


def test_hot_keys_finds_the_heavy_one(spark, skewed_lines):
    assert hot_keys(skewed_lines, ["k"], share=0.2) == hashes(spark, (7,))
    assert hot_keys(skewed_lines.filter(F.lit(False)), ["k"]) == []


def test_hot_keys_are_few_even_over_many_values(spark):
    assert hot_keys(spark.range(200_000).repartition(8), ["id"], share=0.01) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, skewed_lines, side, how, no_broadcast):
    expected = rows(skewed_lines.join(side, ["k"], how))
    assert rows(salted_join(skewed_lines, side, ["k"], hashes(spark, (7,), (3,)), how, salts=5)) == expected
    assert rows(skew_join(skewed_lines, side, "k", how)) == expected


def test_salted_join_spreads_the_hot_key(spark, skewed_lines, side, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(skewed_lines, side, ["k"], hashes(spark, (7,)), "inner", salts=16).filter("k = 7")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == skewed_lines.filter("k = 7").count() and len(sizes) > 4 and max(sizes) < sum(sizes) / 2


def test_salted_join_on_two_keys(spark, no_broadcast):
    big = spark.range(200).select((F.col("id") % 3).alias("a"), (F.col("id") % 4).alias("b"), "id")
    ref = big.select("a", "b").distinct().withColumn("v", F.col("a") * 10 + F.col("b"))
    assert rows(salted_join(big, ref, ["a", "b"], hashes(spark, (0, 0), (1, 3)), salts=3)) == rows(big.join(ref, ["a", "b"]))


def test_salted_join_across_key_types(spark, skewed_lines, side, no_broadcast):
    narrow = side.withColumn("k", F.col("k").cast("int"))
    got = salted_join(skewed_lines, narrow, ["k"], hashes(spark, (7,)), "inner", salts=5)
    assert rows(got) == rows(skewed_lines.join(side, "k"))


def test_salted_join_refuses_full_outer(skewed_lines, side):
    with pytest.raises(ValueError):
        salted_join(skewed_lines, side, ["k"], [], "full_outer")


def test_top1_breaks_ties_by_order(spark):
    df = inline_table(spark, [(1, "M", 5), (1, "L", 5), (1, "S", 4), (2, "S", 1)], "lote int, calibre string, kilos int")
    assert rows(top1_per_group(df, ["lote"], [F.desc("kilos"), F.asc("calibre")])) == [(1, "L", 5), (2, "S", 1)]


def test_keep_first_is_case_sensitive_and_keeps_null_group(spark):
    df = inline_table(spark, [(7, "Oviedo"), (3, "oviedo"), (5, "Oviedo"), (9, None), (8, None)], "id int, ciudad string")
    assert rows(keep_first(df, ["ciudad"], ["id"])) == [(3, "oviedo"), (5, "Oviedo"), (8, None)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_assign_sk_is_dense_and_ordered(spark, partitions):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("n")).repartition(partitions)
    numbered = assign_sk(df, "sk", [F.desc("n")], start=11)
    assert [(r.sk, r.n) for r in numbered.orderBy("sk").collect()] == [(11 + i, 499 - i) for i in range(500)]


def test_assign_sk_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_sk(spark.range(2000).repartition(5), "sk", ["id"])
        assert numbered.filter("sk <> id + 1").count() == 0 and numbered.count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_assign_sk_of_nothing(spark):
    assert assign_sk(spark.range(0), "sk", ["id"]).count() == 0


def test_lookup_default_null_key_and_first_match(spark, no_broadcast):
    df = inline_table(spark, [(1, "a"), (2, "x"), (3, None)], "id int, k string")
    ref = inline_table(spark, [("a", 20, 2), ("a", 10, 1), (None, 99, 1)], "k string, v int, o int")
    got = lookup(df, ref, {"k": "k"}, {"v": ("valor", 0)}, first_by=["o"])
    assert rows(got) == [(1, "a", 10), (2, "x", 0), (3, None, 0)]


def test_lookup_keeps_a_matched_null(spark):
    df = inline_table(spark, [(1, "a"), (2, "b"), (3, "c")], "id int, k string")
    ref = inline_table(spark, [("a", 20), ("b", None)], "k string, v int")
    assert rows(lookup(df, ref, {"k": "k"}, {"v": ("valor", 0)})) == [(1, "a", 20), (2, "b", None), (3, "c", 0)]


def test_lookup_value_may_be_the_key(spark):
    df = inline_table(spark, [(1, 5), (2, 6), (3, None)], "id int, estacion int")
    ref = inline_table(spark, [(5,)], "estacion int")
    got = lookup(df, ref, {"estacion": "estacion"}, {"estacion": ("lkp", -1)})
    assert rows(got) == [(1, 5, 5), (2, 6, -1), (3, None, -1)]


def test_orphans_include_null_keys(spark):
    df = inline_table(spark, [(1, 5), (2, 6), (3, None)], "id int, k int")
    assert rows(orphans(df, inline_table(spark, [(5,)], "k int"), {"k": "k"})) == [(2, 6), (3, None)]


def test_resolve_and_unresolved_keys(spark):
    source = inline_table(spark, [(1, "a", "x"), (2, "b", "x"), (3, "a", "z")], "id int, p string, q string")
    dims = {"p_sk": (inline_table(spark, [(10, "a")], "p_sk int, name string"), {"p": "name"}),
            "q_sk": (inline_table(spark, [(20, "x")], "q_sk int, name string"), {"q": "name"})}
    assert rows(resolve_keys(source, dims).select("id", "p_sk", "q_sk")) == [(1, 10, 20)]
    assert rows(unresolved(source, dims).select("dimension", "id")) == [("p_sk", 2), ("q_sk", 3)]


def test_rekey(spark):
    old = inline_table(spark, [(1, "a"), (2, "b")], "sk int, name string")
    new = inline_table(spark, [(7, "b"), (8, "a")], "sk int, name string")
    fact = inline_table(spark, [(1, 100), (2, 200), (1, 300)], "sk int, m int")
    assert rows(rekey(fact, {"sk": key_map(old, new, "sk", ["name"])})) == [(7, 200), (8, 100), (8, 300)]


@pytest.fixture(params=["10MB", "-1"])
def target(spark, request):
    """A merge target; the source counts as small once and as large once."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield merge_target(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def merge_target(spark):
    return inline_table(spark, [(1, "a", 10), (2, "b", 20), (None, "n", 0)], "id int, nombre string, saldo int")


def test_upsert_updates_and_inserts(spark, target):
    source = inline_table(spark, [(2, "B", 21), (3, "C", 31)], "id int, nombre string, saldo int")
    expected = [(1, "a", 10), (2, "B", 21), (3, "C", 31), (None, "n", 0)]
    once = upsert(target, source, ["id"])
    assert rows(once) == expected
    assert rows(upsert(once, source, ["id"])) == expected


def test_upsert_last_row_wins(spark, target):
    source = inline_table(spark, [(2, "old", 1, 1), (2, "new", 2, 2)], "id int, nombre string, saldo int, v int")
    assert (2, "new", 2) in rows(upsert(target, source, ["id"], order_by=["v"]))


def test_upsert_flags(spark, target):
    source = inline_table(spark, [(2, "B", 21), (3, "C", 31)], "id int, nombre string, saldo int")
    got = upsert(target, source, ["id"], update_cols=["saldo"], insert_only_cols=["nombre"])
    assert rows(got) == [(1, "a", 10), (2, "b", 21), (3, "C", 31), (None, "n", 0)]
    partial = upsert(target, source, ["id"], update_cols=["saldo"])
    assert (3, None, 31) in rows(partial) and (2, "b", 21) in rows(partial)


def test_upsert_can_set_null(spark, target):
    source = inline_table(spark, [(1, None, 5)], "id int, nombre string, saldo int")
    assert (1, None, 5) in rows(upsert(target, source, ["id"]))


def test_upsert_null_keys_are_always_inserted(spark, target):
    source = inline_table(spark, [(None, "x", 1, 1), (None, "y", 2, 1), (None, "y", 2, 1)], "id int, nombre string, saldo int, v int")
    got = Counter(r[1] for r in rows(upsert(target, source, ["id"], order_by=["v"])) if r[0] is None)
    assert got == {"n": 1, "x": 1, "y": 2}


def test_small_source_does_not_move_the_target(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")
    merged = upsert(orders, inline_table(spark, [(1, "X")], "o_orderkey bigint, o_orderstatus string"), ["o_orderkey"])
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in text and "FullOuter" not in text and "Exchange hashpartitioning" not in text
    assert merged.filter("o_orderstatus = 'X'").count() == 1 and merged.count() == orders.count()


def test_upsert_empty_sides(spark, target):
    nothing = target.filter(F.lit(False))
    assert rows(upsert(target, nothing, ["id"])) == rows(target)
    assert rows(upsert(nothing, target, ["id"])) == rows(target)


def test_upsert_keeps_surrogates_and_numbers_new_rows(spark):
    dim = inline_table(spark, [(5, 100, "a"), (9, 200, "b")], "sk bigint, id int, nombre string")
    source = inline_table(spark, [(300, "d"), (200, "B"), (250, "c")], "id int, nombre string")
    expected = [(10, 250, "c"), (11, 300, "d"), (5, 100, "a"), (9, 200, "B")]
    once = upsert(dim, source, ["id"], sk="sk")
    assert rows(once) == expected
    assert rows(upsert(once, source, ["id"], sk="sk")) == expected


def test_insert_if_absent_first_wins(spark, target):
    source = inline_table(spark, [(1, "z", 0), (4, "q", 2), (4, "p", 1), (None, "m", 1), (None, "l", 1)], "id int, nombre string, saldo int")
    got = rows(insert_if_absent(target, source, ["id"], ["nombre"]))
    assert (1, "a", 10) in got and (4, "p", 1) in got and (4, "q", 2) not in got
    assert sum(r[0] is None for r in got) == 3


def test_route_sends_unknown_to_rejected(spark):
    df = inline_table(spark, [(1, 5), (2, -5), (3, None)], "id int, v int")
    ok, rejected = route(df, F.col("v") > 0)
    assert rows(ok) == [(1, 5)] and rows(rejected) == [(2, -5), (3, None)]
    assert rows(tagged(df, F.col("v") > 0).select("id", "ok")) == [(1, True), (2, False), (3, False)]


def test_reshape(spark):
    df = inline_table(spark, [(1, 10)], "id int, v int")
    assert select_values(df, {"v": "valor"}).columns == ["valor"]
    assert rows(add_constant(df, "c", "x")) == [(1, 10, "x")]
    assert rows(retype(df, {"v": "decimal(6,1)"})) == [(1, Decimal("10.0"))]
    assert rows(expand_list(df, "t", ["S", "M"])) == [(1, 10, "M"), (1, 10, "S")]
    got = unpivot_exprs(df, [("a", F.col("v") + 1), ("b", F.col("v") * 2)], "k", "x", keep=["id"])
    assert rows(got) == [(1, "a", 11), (1, "b", 20)]


def test_quality_rules(spark):
    df = inline_table(spark, [(1, "a", 5, None), (2, None, -1, "zz"), (2, "bad", None, "largo")], "id int, d string, n int, t string")
    parent = inline_table(spark, [("a",)], "d string")
    got = quality.validate(df, ["id"], [
        quality.not_null("d"), quality.in_range("n", 0), quality.in_domain("d", ("a", "b")), quality.max_length("t", 3),
        quality.Unique(["id"]), quality.ForeignKey(["d"], parent)])
    assert rows(got) == [
        ("domain:d", "2", "bad"), ("foreign_key:d", "2", "bad"), ("length:t", "2", "largo"), ("not_null:d", "2", None),
        ("range:n", "2", "-1"), ("unique:id", "2", "2")]


def test_row_rules_scan_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    report = quality.row_violations(orders, ["o_orderkey"], [
        quality.not_null("o_custkey"), quality.in_range("o_totalprice", 0), quality.in_domain("o_orderstatus", ("O", "F"))])
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_reconcile(spark):
    a = inline_table(spark, [("x", 1), ("y", 2), (None, 3), ("z", 9)], "k string, m int")
    b = inline_table(spark, [("x", 1), ("y", 4), (None, 3), ("w", 7)], "k string, m int")
    got = rows(reconcile(a, b, ["k"], ["m"], tolerance=1).select("k", "estado", "medida"))
    assert got == [("w", "only_b", "m"), ("y", "differs", "m"), ("z", "only_a", "m")]
    assert reconcile(a, b, ["k"], ["m"], tolerance=2).filter("estado = 'differs'").count() == 0


def test_reconcile_many(spark):
    from starfold.operators.reconcile import reconcile_many

    rows = lambda items: spark.createDataFrame(items, "k string, n int, m int").withColumn("m", F.col("m").cast("decimal(10,2)"))
    sides = {"a": rows([("x", 1, 1), ("x", 1, 2), (None, 1, 5), ("y", 2, None)]), "b": rows([("x", 1, 3), (None, 1, 5), ("y", 2, None)]),
             "c": rows([("x", 1, 4), (None, 1, 5), ("z", 2, 7)])}
    got = {(r.k, r.estado): (r.valor_a, r.valor_b, r.valor_c) for r in reconcile_many(sides, ["k", "n"], ["m"]).collect()}
    assert got == {("x", "differs"): (3, 3, 4), ("y", "missing"): (None, None, None), ("z", "missing"): (None, None, 7)}
