"""Weather cleaning: sensor rules, orphan log, deduplication, climate dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import band, flag, negative_to_zero, ordered_pair, outside_to_null, sentinel_to_null
from ..functions.text import canonical, in_vocabulary
from ..operators.dedup import keep_first
from ..operators.lookup import lookup
from ..operators.reshape import retype, select_values
from ..operators.route import route
from ..operators.upsert import upsert

# Spellings, vocabulary, thresholds.
CITY_SPELLINGS = {
    "Granada": ["granada", "grañada"],
    "Sevilla": ["sevilla", "sevila"],
    "Málaga": ["málaga", "malaga"],
    "Madrid": ["madrid", "madríd", "madri"],
    "Barcelona": ["barcelona", "barceloña"],
    "Valencia": ["valencia", "valençia"],
    "Bilbao": ["bilbao"],
    "Zaragoza": ["zaragoza"],
    "Alicante": ["alicante", "alacant"],
    "Murcia": ["murcia"],
}
CONDITIONS = ["Soleado", "Nublado", "Lluvia", "Tormenta", "Nieve", "Niebla", "Ventoso", "Parcialmente nublado"]
UNKNOWN_CONDITION = "Desconocido"
SENSOR_ERROR = -99
TEMPERATURE_BANDS = [(0, "Muy fria"), (10, "Fria"), (20, "Templada")]
HOT, UNKNOWN_BAND = "Calurosa", "Desconocida"
RAIN_DAY_MM = 1.0
NO_STATION = -1

COLUMNS = ["observacion_id", "fecha", "ciudad", "estacion_id", "temp_max", "temp_min", "temp_media",
           "precipitacion_mm", "humedad_pct", "velocidad_viento_kmh", "condicion_climatica"]
TYPES = {"temp_max": "decimal(5,1)", "temp_min": "decimal(5,1)", "temp_media": "decimal(5,1)",
         "precipitacion_mm": "decimal(6,1)", "humedad_pct": "int", "velocidad_viento_kmh": "decimal(5,1)"}
CLIMATE_COLUMNS = ["fecha", "ciudad", "anio", "mes", "dia_del_anio", "temp_max", "temp_min", "temp_media",
                   "precipitacion_mm", "humedad_pct", "velocidad_viento_kmh", "condicion_climatica",
                   "es_dia_lluvia", "categoria_temperatura"]


def sensor_rules(observations: DataFrame) -> DataFrame:
    """Clean every reading.

    Sensor errors become NULL before the pair is ordered, so an error is never
    swapped in; rain is clamped, so an error there becomes no rain.
    """
    temps = observations.withColumns({
        c: sentinel_to_null(c, SENSOR_ERROR) for c in ("temp_max", "temp_min", "temp_media")})
    low, high = ordered_pair("temp_min", "temp_max")
    cleaned = temps.withColumns({
        "temp_min": low,
        "temp_max": high,
        "precipitacion_mm": negative_to_zero("precipitacion_mm"),
        "humedad_pct": outside_to_null("humedad_pct", 0, 100),
        "ciudad": canonical("ciudad", CITY_SPELLINGS),
        "condicion_climatica": in_vocabulary("condicion_climatica", CONDITIONS, UNKNOWN_CONDITION),
    })
    return retype(cleaned, TYPES)


def has_reading(columns: Sequence[str] = ("temp_max", "temp_min", "precipitacion_mm")):
    """At least one of the readings is there; the mean alone does not count."""
    return F.coalesce(*[F.col(c) for c in columns]).isNotNull()


def classify(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Cleaned observations with their outcome: ``discarded``, ``orphan`` or ``accepted``.

    One pass; write it once partitioned by ``outcome`` when several branches are used.
    """
    cleaned = sensor_rules(observations)
    known = lookup(cleaned, stations, {"estacion_id": "estacion_id"}, {"estacion_id": ("lkp_estacion", NO_STATION)},
                   first_by=["estacion_id", *[c for c in stations.columns if c != "estacion_id"]])
    outcome = F.when(~has_reading(), "discarded").when(F.col("lkp_estacion") == NO_STATION, "orphan")
    return known.withColumn("outcome", outcome.otherwise("accepted"))


def accepted(classified: DataFrame) -> DataFrame:
    """One observation per date and city, the one with the lowest identifier."""
    rows = classified.filter(F.col("outcome") == "accepted")
    return select_values(keep_first(rows, ["fecha", "ciudad"], ["observacion_id"]), COLUMNS)


def orphan_log(classified: DataFrame) -> DataFrame:
    """Observations of unknown stations with all their fields."""
    return select_values(classified.filter(F.col("outcome") == "orphan"), [*COLUMNS, "lkp_estacion"])


def discarded(classified: DataFrame) -> DataFrame:
    return select_values(classified.filter(F.col("outcome") == "discarded"), COLUMNS)


def climate_rows(clean: DataFrame) -> DataFrame:
    """Rows of the climate dimension with its derived columns."""
    fecha = F.col("fecha")
    derived = clean.withColumns({
        "anio": F.year(fecha), "mes": F.month(fecha), "dia_del_anio": F.dayofyear(fecha),
        "es_dia_lluvia": flag(F.col("precipitacion_mm") > RAIN_DAY_MM),
        "categoria_temperatura": band("temp_media", TEMPERATURE_BANDS, HOT, UNKNOWN_BAND),
    })
    return select_values(derived, CLIMATE_COLUMNS)


def without_key(clean: DataFrame) -> DataFrame:
    """Accepted rows that lack a date or a city: they have no key to be merged by and belong in the reject log."""
    return clean.filter(F.col("fecha").isNull() | F.col("ciudad").isNull())


def with_key(clean: DataFrame) -> DataFrame:
    return clean.filter(F.col("fecha").isNotNull() & F.col("ciudad").isNotNull())


def load_staging(staging: DataFrame, clean: DataFrame) -> DataFrame:
    """Staging after an idempotent upsert by date and city; :func:`without_key` gives the rows that cannot take part."""
    return upsert(staging, with_key(clean), ["fecha", "ciudad"], order_by=["observacion_id"])


def load_climate(climate: DataFrame, clean: DataFrame) -> DataFrame:
    """Climate dimension after an idempotent upsert by date and city; :func:`without_key` gives the rows that cannot take part."""
    return upsert(climate, climate_rows(with_key(clean)), ["fecha", "ciudad"])


def split_by_station(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(known, orphan) parts of looked-up observations."""
    return route(observations, F.col("lkp_estacion") != NO_STATION)
