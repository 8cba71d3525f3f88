"""The weather and customer jobs with their sinks, and key checks of increments."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starfold.operators.quality import ForeignKey, duplicate_keys, missing_parents
from starfold.plans import customers as customer_plans
from starfold.plans import jobs, weather
from starfold.plans.key_checks import all_repeated, check_references, check_unique
from starfold.sinks import Load, VersionedLayer

OBSERVED = ("observacion_id bigint, fecha date, ciudad string, estacion_id bigint, temp_max decimal(5,1), temp_min decimal(5,1), "
            "temp_media decimal(5,1), precipitacion_mm decimal(6,1), humedad_pct int, velocidad_viento_kmh decimal(5,1), condicion_climatica string")


def observation(i, day, city, station, top=20):
    return (i, None if day is None else datetime.date(2024, 1, day), city, station, None if top is None else Decimal(top), None, None, None, 50, None, "Soleado")


ROWS = [observation(1, 1, "madrid", 1), observation(2, 1, "Madríd", 1, 30), observation(3, 2, "Bilbao", 9), observation(4, 2, "Bilbao", None),
        observation(5, 3, None, 1), observation(6, None, "Bilbao", 1), observation(7, 3, "Bilbao", 1, None), observation(8, 3, "Bilbao", 1, -99), observation(9, 4, "Bilbao", 1)]


@pytest.fixture
def layer(spark, tmp_path):
    return VersionedLayer(spark, str(tmp_path / "layer"))


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([(1, "uno")], "estacion_id bigint, nombre_estacion string")


def test_weather_outcomes_add_up(spark, layer, stations, monkeypatch):
    rows = spark.createDataFrame(ROWS, OBSERVED)
    monkeypatch.setattr(Load, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.clean_weather(layer, "r1", rows, stations)
    monkeypatch.undo()
    assert layer.current() is None
    counts = jobs.clean_weather(layer, "r1", rows, stations)
    assert counts == {"accepted": 3, "orphan": 2, "discarded": 2, "without_key": 2} and sum(counts.values()) == len(ROWS)
    assert jobs.clean_weather(layer, "r1", rows, stations) == counts and layer.current() == 1
    assert {(r.fecha.day, r.ciudad, r.temp_max) for r in layer.read("meteo.staging").collect()} == {(1, "Madrid", 20), (4, "Bilbao", 20)}
    assert layer.read("meteo.dim_clima").columns == weather.CLIMATE_COLUMNS and layer.read("meteo.dim_clima").count() == 2
    assert layer.read("meteo.huerfanas").count() == 2 and layer.read("meteo.rechazos").count() == 2
    later = spark.createDataFrame([observation(20, 4, "Bilbao", 1, 5), observation(21, 9, "Bilbao", 1)], OBSERVED)
    assert jobs.clean_weather(layer, "r2", later, stations)["accepted"] == 2
    assert {(r.fecha.day, r.temp_max) for r in layer.read("meteo.staging").collect()} == {(1, 20), (4, 5), (9, 20)}
    nothing = jobs.clean_weather(layer, "r3", later.limit(0), stations)
    assert set(nothing.values()) == {0} and layer.read("meteo.staging").count() == 3


def test_the_input_is_read_once(spark, layer, stations, tmp_path):
    """Readings are counted by an accumulator as they are read: every branch, sink and count takes one pass.

    (Stations too many for a broadcast cost another pass over the station column, to find the hot ones.)
    """
    stations.write.parquet(str(tmp_path / "stations"))
    spark.createDataFrame(ROWS, OBSERVED).write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    rows = spark.read.parquet(str(tmp_path / "in")).mapInArrow(lambda batches: (seen.add(b.num_rows) or b for b in batches), schema)
    assert sum(jobs.clean_weather(layer, "r1", rows, spark.read.parquet(str(tmp_path / "stations"))).values()) == seen.value == len(ROWS)


def test_rows_without_an_outcome_are_an_error(spark):
    with pytest.raises(ValueError, match="none of the outcomes"):
        jobs.split_once(spark.range(4), F.when(F.col("id") > 0, "a").when(F.col("id") > 9, "b"), ["a", "b"])


CUSTOMER = "cliente_id bigint, nombre_cliente string, tipo_cliente string, canal string, segmento string, pais string, ciudad string, email string, telefono string"


def customer(i, email, name="ana"):
    return (i, name, "retail", "directo", "x", "p", "c", email, "1")


def test_customer_outcomes_add_up(spark, layer):
    first = [customer(5, "a@b"), customer(7, None), customer(None, "n@n"), customer(9, " C@D ", "zoe"), customer(9, "c@d", "ada")]
    counts = jobs.load_customers(layer, "r1", spark.createDataFrame(first, CUSTOMER))
    assert counts == {"accepted": 3, "bad_email": 1, "without_key": 1}
    assert {r.cliente_id: (r.cliente_sk, r.nombre_cliente) for r in layer.read("ventas.dim_cliente").collect()} == {5: (1, "Ana"), 9: (2, "Zoe")}
    second = [customer(1, "q@q"), customer(9, "new@d", "eva"), customer(7, "bad"), customer(8, "")]
    assert jobs.load_customers(layer, "r2", spark.createDataFrame(second, CUSTOMER))["bad_email"] == 2
    assert {r.cliente_id: (r.cliente_sk, r.email) for r in layer.read("ventas.dim_cliente").collect()} == {5: (1, "a@b"), 9: (2, "new@d"), 1: (3, "q@q")}
    assert {r.clienteid: r.email for r in layer.read("ventas.errores").collect()} == {7: None, 8: ""}, "the first error of a customer stays"
    assert layer.read("ventas.rechazos").count() == 1
    assert jobs.load_customers(layer, "r1", spark.createDataFrame(second, CUSTOMER)) == counts, "a run is loaded once"
    assert layer.read("ventas.staging").columns == list(customer_plans.STAGING_NAMES.values())


def test_key_checks_equal_full_validation(spark, layer):
    batches = [[(i, i % 7) for i in range(50)] + [(3, 3), (None, 1)], [(i, i % 7) for i in range(45, 300)] + [(49, 0)] * 3, [], [(3, 3), (1000, 6)]]
    frames = [spark.createDataFrame(b, "a int, b int") for b in batches]
    for frame in frames:
        load = layer.load()
        found = check_unique(load, "keys", frame, ["a", "b"], rows_per_part=10)
        hit = {r.key for r in found.collect()}
        load.commit()
        assert hit <= {f"{r.a}|{r.b}" for r in frame.dropna().collect()}, "a load answers for its own keys"
    whole = frames[0].union(frames[1]).union(frames[2]).union(frames[3])
    assert sorted(map(str, all_repeated(layer.load(), "keys").collect())) == sorted(map(str, duplicate_keys(whole, ["a", "b"]).collect()))
    lines = spark.createDataFrame([(1, 4, 4), (2, 4, 5), (3, None, 1), (4, 5000, 1), (5, 299, 5)], "id int, x int, y int")
    expected = missing_parents(lines, ["id"], ForeignKey(["x", "y"], whole, ["a", "b"]))
    assert sorted(map(str, check_references(layer.load(), "keys", lines, ["id"], ["x", "y"]).collect())) == sorted(map(str, expected.collect()))
