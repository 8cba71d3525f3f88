"""The weather and customer jobs from input to sinks: one pass over the input, one published version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keep_first
from ..operators.joins import any_null
from ..operators.reshape import select_values
from ..operators.upsert import absent_rows
from ..session import scratch_path, written
from ..sinks import Load, VersionedLayer, merge_parts, stable_keys, write_parts
from . import customers as customer_plans
from . import weather

OUTCOME, WITHOUT_KEY = "outcome", "without_key"
#: Rows of a run by outcome.
RUNS = "ejecuciones"
_RUN_SCHEMA = "run_id string, outcome string, filas bigint"


def split_once(rows: DataFrame, outcome: Column, outcomes: Sequence[str]) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The rows of each outcome and how many they are, in one pass over ``rows``.

    They are written once, a folder for each outcome, and counted on the way; the
    branches read their own folders.
    """
    tagged = rows.withColumn(OUTCOME, outcome)
    seen = Observation()
    counted = tagged.observe(seen, *[F.count(F.when(F.col(OUTCOME) == o, 1)).alias(o) for o in outcomes], F.count(F.lit(1)).alias("_all"))
    path = scratch_path(rows.sparkSession, "outcomes")
    counted.write.partitionBy(OUTCOME).parquet(path)
    counts = dict(seen.get)
    if sum(counts[o] for o in outcomes) != counts["_all"]:
        raise ValueError(f"of {counts['_all']} rows some have none of the outcomes {outcomes}")
    stored = rows.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField(OUTCOME, T.StringType())])).parquet(path)
    return {o: stored.filter(F.col(OUTCOME) == o).drop(OUTCOME) for o in outcomes}, {o: counts[o] for o in outcomes}


def _log_run(load: Load, prefix: str, run_id: str, counts: dict[str, int]) -> None:
    rows = load.layer.spark.createDataFrame([(run_id, o, n) for o, n in counts.items()], _RUN_SCHEMA)
    load.append(f"{prefix}.{RUNS}", rows)


def counts_of(layer: VersionedLayer, prefix: str, run_id: str) -> dict[str, int]:
    """What a published run has counted."""
    return {r.outcome: r.filas for r in layer.read(f"{prefix}.{RUNS}").filter(F.col("run_id") == run_id).collect()}


def _merge(load: Load, table: str, rows: DataFrame, keys: Sequence[str], rows_per_part: int) -> None:
    if table not in load:
        write_parts(load, table, rows.limit(0), keys, rows_per_part)
    merge_parts(load, table, rows)


def clean_weather(layer: VersionedLayer, run_id: str, observations: DataFrame, stations: DataFrame, rows_per_part: int = 1_000_000) -> dict[str, int]:
    """Clean ``observations`` and load every branch; rows by outcome, which add up to the input.

    ``accepted`` rows, one per date and city, are merged into ``meteo.staging`` and
    ``meteo.dim_clima``; ``orphan`` rows and those ``without_key`` are logged with the
    run in ``meteo.huerfanas`` and ``meteo.rechazos``; ``discarded`` ones are counted
    only. All become visible together, once for each ``run_id``.
    """
    load = layer.load(run_id)
    if load.applied:
        return counts_of(layer, "meteo", run_id)
    classified = weather.classify(observations, stations).withColumnRenamed(OUTCOME, "_found")
    keyless = (F.col("_found") == "accepted") & any_null(["fecha", "ciudad"])
    parts, counts = split_once(
        classified, F.when(keyless, WITHOUT_KEY).otherwise(F.col("_found")), ["accepted", "orphan", "discarded", WITHOUT_KEY])
    clean = written(select_values(keep_first(parts["accepted"], ["fecha", "ciudad"], ["observacion_id"]), weather.COLUMNS), "weather-clean")
    _merge(load, "meteo.staging", clean, ["fecha", "ciudad"], rows_per_part)
    _merge(load, "meteo.dim_clima", weather.climate_rows(clean), ["fecha", "ciudad"], rows_per_part)
    run = F.lit(run_id).alias("run_id")
    load.append("meteo.huerfanas", parts["orphan"].select(*weather.COLUMNS, "lkp_estacion", run))
    load.append("meteo.rechazos", parts[WITHOUT_KEY].select(*weather.COLUMNS, run))
    _log_run(load, "meteo", run_id, counts)
    load.commit()
    return counts


def load_customers(layer: VersionedLayer, run_id: str, customers: DataFrame, rows_per_part: int = 1_000_000) -> dict[str, int]:
    """Clean ``customers`` and load every branch; rows by outcome, which add up to the input.

    ``accepted`` rows are merged into ``ventas.staging`` and, with the keys of the
    registry ``ventas.claves``, into ``ventas.dim_cliente``; those with a ``bad_email`` go to
    ``ventas.errores``, where the first error of a customer stays; those ``without_key`` to
    ``ventas.rechazos`` with the run. Of rows with the same identifier the one whose columns
    sort last wins. All become visible together, once for each ``run_id``.
    """
    load = layer.load(run_id)
    if load.applied:
        return counts_of(layer, "ventas", run_id)
    rows = customer_plans.normalise(customers)
    outcome = F.when(F.col("cliente_id").isNull(), WITHOUT_KEY).when(customer_plans.valid_email(), "accepted").otherwise("bad_email")
    parts, counts = split_once(rows, outcome, ["accepted", "bad_email", WITHOUT_KEY])
    last = lambda df, key: keep_first(df, [key], [F.col(c).desc() for c in df.columns])
    staging = written(last(customer_plans.staging_rows(parts["accepted"]), "clienteid"), "customers-clean")
    _merge(load, "ventas.staging", staging, ["clienteid"], rows_per_part)
    dimension = select_values(staging, customer_plans.DIM_NAMES)
    keyed = written(stable_keys(load, "ventas.claves", dimension, ["cliente_id"], "cliente_sk"), "customers-keyed")
    _merge(load, "ventas.dim_cliente", keyed.select("cliente_sk", *dimension.columns), ["cliente_id"], rows_per_part)
    errors = keep_first(customer_plans.error_rows(parts["bad_email"]), ["clienteid"], ["email", "motivo"])
    known = load.read("ventas.errores") if "ventas.errores" in load else errors.limit(0)
    load.append("ventas.errores", absent_rows(known, errors, ["clienteid"]))
    load.append("ventas.rechazos", parts[WITHOUT_KEY].withColumn("run_id", F.lit(run_id)))
    _log_run(load, "ventas", run_id, counts)
    load.commit()
    return counts
