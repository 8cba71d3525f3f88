import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starfold.plans import customers, weather
from starfold.schemas import WEATHER
from starfold.sources import inline_table

DAY = datetime.date(2024, 3, 1)
BASE = dict(fecha=DAY, ciudad="Murcia", estacion_id=1, temp_max=20.0, temp_min=10.0, temp_media=15.0,
            precipitacion_mm=0.5, humedad_pct=50, velocidad_viento_kmh=3.0, condicion_climatica="Soleado")


def observation(ident, **changes):
    row = {**BASE, **changes}
    plain = [row[c] for c in weather.COLUMNS[1:]]
    return (ident, *[Decimal(str(v)) if isinstance(v, float) else v for v in plain])


def observations(spark, *given):
    schema = WEATHER["observaciones_diarias"].schema
    return spark.createDataFrame(list(given), schema)


@pytest.fixture(scope="module")
def stations(spark):
    return inline_table(spark, [(1, "A"), (2, "B")], "estacion_id bigint, nombre_estacion string")


def one(spark, **changes):
    return weather.sensor_rules(observations(spark, observation(1, **changes))).first()


def test_sensor_error_becomes_null_and_is_not_swapped(spark):
    row = one(spark, temp_max=-99.0, temp_min=10.0)
    assert row.temp_max is None and row.temp_min == 10


@pytest.mark.parametrize("rain", [-3.0, -99.0])
def test_negative_rain_becomes_zero(spark, stations, rain):
    classified = weather.classify(observations(spark, observation(1, precipitacion_mm=rain, temp_max=None, temp_min=None)), stations)
    row = classified.first()
    assert row.precipitacion_mm == 0 and row.outcome == "accepted"


@pytest.mark.parametrize("humidity, expected", [(-1, None), (0, 0), (100, 100), (101, None)])
def test_humidity(spark, humidity, expected):
    assert one(spark, humedad_pct=humidity).humedad_pct == expected


@pytest.mark.parametrize("city, expected", [(" sevila ", "Sevilla"), ("MALAGA", "Málaga"), ("Almería", "Almería"), (None, None)])
def test_city_spelling(spark, city, expected):
    assert one(spark, ciudad=city).ciudad == expected


def test_inverted_temperatures_are_swapped_and_the_mean_stays(spark):
    row = one(spark, temp_min=20.0, temp_max=5.0, temp_media=9.0)
    assert (row.temp_min, row.temp_max, row.temp_media) == (5, 20, 9)


@pytest.mark.parametrize("condition, expected", [(None, "Desconocido"), ("", "Desconocido"), ("Granizo", "Desconocido"), (" Soleado ", " Soleado ")])
def test_condition_vocabulary(spark, condition, expected):
    assert one(spark, condicion_climatica=condition).condicion_climatica == expected


def test_outcomes(spark, stations):
    given = observations(
        spark, observation(1), observation(2, estacion_id=77), observation(3, estacion_id=None),
        observation(4, temp_max=None, temp_min=None, precipitacion_mm=None),
        observation(5, temp_max=None, temp_min=None, precipitacion_mm=None, estacion_id=77))
    classified = weather.classify(given, stations)
    assert {r.observacion_id: r.outcome for r in classified.collect()} == {
        1: "accepted", 2: "orphan", 3: "orphan", 4: "discarded", 5: "discarded"}
    log = weather.orphan_log(classified)
    assert sorted(r.observacion_id for r in log.collect()) == [2, 3] and log.columns[-1] == "lkp_estacion"
    assert sorted(r.observacion_id for r in weather.discarded(classified).collect()) == [4, 5]


def test_deduplication_uses_the_canonical_city(spark, stations):
    given = observations(spark, observation(7, ciudad="malaga"), observation(3, ciudad="Málaga"))
    assert [r.observacion_id for r in weather.accepted(weather.classify(given, stations)).collect()] == [3]


@pytest.mark.parametrize("rain, expected", [(None, False), (1.0, False), (1.1, True)])
def test_rain_flag(spark, rain, expected):
    clean = observations(spark, observation(1, precipitacion_mm=rain))
    assert weather.climate_rows(clean).first().es_dia_lluvia is expected


def test_climate_load_is_idempotent(spark, stations):
    clean = weather.accepted(weather.classify(observations(spark, observation(1), observation(2, ciudad="Bilbao")), stations))
    empty = weather.climate_rows(clean).filter(F.lit(False))
    once = weather.load_climate(empty, clean)
    twice = weather.load_climate(once, clean)
    assert once.count() == twice.count() == 2 and once.exceptAll(twice).count() == 0
    assert twice.columns == WEATHER["dim_clima"].names


@pytest.fixture(scope="module")
def dirty_customers(spark):
    """60 customers: 8 without e-mail, 5 with a malformed one, 12 in capitals."""
    i = F.col("id")
    return spark.range(1, 61).select(
        i.alias("cliente_id"),
        F.when(i <= 12, F.concat(F.lit("  CLIENTE NUMERO "), i.cast("string"))).otherwise(F.lit("Cliente Otro")).alias("nombre_cliente"),
        F.lit("B1").alias("cif"), F.element_at(F.array(F.lit("mayorista"), F.lit("otro")), (i % 2 + 1).cast("int")).alias("tipo_cliente"),
        F.lit("directo").alias("canal"), F.lit("premium").alias("segmento"), F.lit("Espana").alias("pais"), F.lit("Madrid").alias("ciudad"),
        F.when(i % 8 == 1, F.lit(None)).when((i % 12 == 4), F.lit("sin-arroba.example.com"))
        .otherwise(F.concat(F.lit(" Cliente"), i.cast("string"), F.lit("@Example.COM "))).alias("email"),
        F.lit("600").alias("telefono"))


def test_customer_cleaning(spark, dirty_customers):
    staging, errors = customers.split_by_email(dirty_customers)
    assert (staging.count(), errors.count()) == (47, 13)
    assert {r.motivo for r in errors.collect()} == {"email inválido o nulo"}
    row = staging.filter("clienteid = 3").first()
    assert (row.nombrecliente, row.email, row.tipocliente) == ("Cliente Numero 3", "cliente3@example.com", "otro")
    assert staging.filter("clienteid = 2").first().tipocliente == "Mayorista"


def test_customer_load_in_one_run_and_again(spark, dirty_customers):
    staging, errors = customers.split_by_email(dirty_customers)
    stored = customers.load_staging(staging.filter(F.lit(False)), staging)
    dim = inline_table(spark, [(1, 2, "viejo")], "cliente_sk bigint, cliente_id bigint, nombre_cliente string").withColumns(
        {c: F.lit(None).cast("string") for c in ("tipo_cliente", "canal", "segmento", "pais_cliente", "ciudad_cliente", "email", "telefono")})
    once = customers.load_dimension(dim, stored)
    twice = customers.load_dimension(once, stored)
    assert once.count() == 47 and once.exceptAll(twice).count() == 0
    assert once.filter("cliente_id = 2").first().cliente_sk == 1
    assert sorted(r.cliente_sk for r in once.collect()) == list(range(1, 48))
    log = customers.load_errors(errors.filter(F.lit(False)), errors)
    changed = errors.withColumn("motivo", F.lit("otro motivo"))
    assert {r.motivo for r in customers.load_errors(log, changed).collect()} == {"email inválido o nulo"}
