"""Loads into a versioned layer: parts, registries, retention, the reject log."""

import datetime

import pytest
from pyspark.sql import functions as F

from starfold.operators.upsert import upsert
from starfold.sinks import VersionedLayer, append_rejects, merge_parts, stable_keys, write_parts


@pytest.fixture
def layer(spark, tmp_path):
    return VersionedLayer(spark, str(tmp_path / "layer"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_load_id_is_applied_once(spark, layer):
    assert layer.publish({"t": spark.range(3)}, load_id="a") == 1
    assert layer.publish(append={"t": spark.range(3)}, load_id="a") == 1 and layer.read("t").count() == 3
    assert layer.publish(append={"t": spark.range(3)}, load_id="b") == 2 and layer.read("t").count() == 6
    assert layer.load("a").applied and not layer.load("c").applied


def test_a_load_reads_what_it_writes(spark, layer):
    load = layer.load()
    assert load.append("t", spark.range(3)).count() == 3 and load.append("t", spark.range(3, 5)).count() == 2
    assert load.read("t").count() == 5 and "t" in load and layer.current() is None
    load.set_note("t", {"x": 1})
    assert load.commit() == 1 and layer.read("t").count() == 5 and layer.note("t") == {"x": 1}


def test_the_later_of_two_loads_on_one_version_fails(spark, layer):
    layer.publish({"t": spark.range(1)})
    one, two = layer.load(), layer.load()
    one.append("t", spark.range(1)), two.append("t", spark.range(1))
    one.commit()
    with pytest.raises(FileExistsError):
        two.commit()
    assert layer.read("t").count() == 2


KEYED = "k int, d date, v string"


def keyed(spark, items, tag):
    day = datetime.date(2024, 1, 1)
    return spark.createDataFrame([(k, None if k is None else day + datetime.timedelta(k % 3), f"{tag}{k}") for k in items], KEYED)


@pytest.mark.parametrize("keys", [["k"], ["d", "k"]])
def test_merged_parts_are_an_upsert(spark, layer, keys):
    base = keyed(spark, range(0, 400, 2), "a")
    load = layer.load()
    write_parts(load, "t", base, keys, rows_per_part=25)
    load.commit()
    parts = load.parts("t")
    assert len(parts) == 8 and sum(p["rows"] for p in parts.values()) == 200
    source = keyed(spark, [3, 4, 5, 5, 6, 390, 391, 900, 901, -7, None, None], "b").withColumn("n", F.monotonically_increasing_id())
    load = layer.load()
    merge_parts(load, "t", source, order_by=["n"])
    load.commit()
    expected = upsert(base, source, keys, order_by=["n"])
    assert rows(layer.read("t")) == rows(expected)
    assert rows(layer.read("t", version=1)) == rows(base), "the former version is as it was"


def test_a_load_rewrites_only_its_parts(spark, layer):
    load = layer.load()
    write_parts(load, "t", keyed(spark, range(1000), "a"), ["k"], rows_per_part=100)
    load.commit()
    before = set(load.parts("t"))
    load = layer.load()
    touched = merge_parts(load, "t", keyed(spark, range(420, 460), "b"))
    load.commit()
    after = set(load.parts("t"))
    assert len(touched) == 1 and len(before & after) == len(before) - 1 and len(after) == len(before)
    load = layer.load()
    assert merge_parts(load, "t", keyed(spark, range(2000, 2250), "c")) == [], "new keys beyond the last part touch none"
    load.commit()
    assert after < set(load.parts("t")) and len(load.parts("t")) == len(after) + 3
    load = layer.load()
    touched = merge_parts(load, "t", keyed(spark, [1500, 2100], "d"))
    assert len(touched) == 2 and load.commit() == 4
    assert layer.read("t").count() == 1251 and layer.read("t").where("v like 'd%'").count() == 2
    scanned = layer.load().read("t", sorted(load.parts("t"))[:1])
    assert scanned.count() < 200


def test_parts_of_empty_tables(spark, layer):
    load = layer.load()
    write_parts(load, "t", keyed(spark, [], "a"), ["k"])
    merge_parts(load, "t", keyed(spark, [], "a"))
    assert load.read("t").count() == 0
    merge_parts(load, "t", keyed(spark, [1, 2], "b"))
    assert load.read("t").count() == 2
    merge_parts(load, "t", keyed(spark, [], "c"))
    load.commit()
    assert layer.read("t").count() == 2
    with pytest.raises(ValueError):
        layer.load().append("t", keyed(spark, [9], "d"))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2)])
def test_keys_survive_loads_in_any_order(spark, layer, order):
    batches = [["b", "a"], ["c", "b", None], ["aa", "c"]]
    known = {}
    for number, at in enumerate(order):
        load = layer.load(f"load-{at}")
        got = {r.name: r.sk for r in stable_keys(load, "names", spark.createDataFrame([(n,) for n in batches[at]], "name string"), ["name"], "sk").collect()}
        load.commit()
        assert set(got) == set(batches[at]) and got.pop(None, None) is None
        assert all(got[n] == known[n] for n in got if n in known), "a key keeps its number"
        known |= got
    assert sorted(known.values()) == [1, 2, 3, 4]
    load = layer.load("rebuild")
    got = stable_keys(load, "names", spark.createDataFrame([("c",), ("zz",), ("a",)], "name string"), ["name"], "sk").collect()
    assert {r.name: r.sk for r in got} == {"c": known["c"], "zz": 5, "a": known["a"]}


def test_retention(spark, layer, tmp_path):
    for at in range(5):
        layer.publish(append={"t": spark.range(at + 1)}, tables={"u": spark.range(at)})
    load = layer.load()
    load.append("t", spark.range(100))  # never committed
    parted = layer.load()
    write_parts(parted, "p", keyed(spark, range(40), "a"), ["k"], rows_per_part=10)
    parted.commit()
    again = layer.load()
    merge_parts(again, "p", keyed(spark, [3], "b"))
    again.commit()
    kept = {v: (rows(layer.read("t", v)), rows(layer.read("u", v))) for v in (5, 6, 7)}
    assert layer.retain(3, grace_seconds=3600) == [], "what is young may belong to a load"
    dropped = layer.retain(3, grace_seconds=0)
    assert sum("/tables/u/" in d for d in dropped) == 4 and sum("/tables/t/" in d for d in dropped) == 1
    assert kept == {v: (rows(layer.read("t", v)), rows(layer.read("u", v))) for v in kept}
    with pytest.raises(FileNotFoundError):
        layer.read("t", 2)
    dropped = layer.retain(1, grace_seconds=0)
    assert sum("/_part=" in d for d in dropped) == 1, "the part that was merged anew"
    assert layer.read("p").count() == 40 and layer.current() == 7
    with pytest.raises(ValueError):
        layer.retain(0)


def test_rejects_of_a_run_are_logged_once(spark, tmp_path):
    log, bad = str(tmp_path / "log"), spark.range(5).withColumn("why", F.lit("x"))
    assert append_rejects(bad, log, "run/1") and not append_rejects(bad, log, "run/1") and append_rejects(bad.limit(2), log, "run 2")
    read = spark.read.parquet(log).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in read} == {"run/1": 5, "run 2": 2}
    failing = bad.withColumn("why", F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise("x"))
    with pytest.raises(Exception):
        append_rejects(failing, log, "run-3")
    assert append_rejects(bad, log, "run-3") and spark.read.parquet(log).where("run_id = 'run-3'").count() == 5


def test_small_parts_grow_with_the_table(spark, layer, monkeypatch):
    """However few rows a part is asked to have, the parts of a large table, which the driver knows, stay few."""
    monkeypatch.setattr("starfold.sinks.parts.MANY_PARTS", 8)
    load = layer.load()
    write_parts(load, "t", keyed(spark, range(400), "a"), ["k"], rows_per_part=5)
    assert len(load.parts("t")) == 8 and load.note("t")["rows_per_part"] == 5
    merge_parts(load, "t", keyed(spark, range(390, 600), "b"))
    load.commit()
    assert len(load.parts("t")) <= 13  # 80 parts, and 120 with the merge, of 5 rows
    assert rows(layer.read("t")) == rows(keyed(spark, range(390), "a").unionByName(keyed(spark, range(390, 600), "b")))
