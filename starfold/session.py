"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from itertools import islice

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings the jobs are written for. Partition counts are left to
#: AQE: it coalesces small shuffles and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


#: Application id -> temporary folder, for local sessions without a shared one.
_local_folders: dict[str, str] = {}


def build_session(app_name: str = "starfold", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A master of threads (``local[...]``) may fall back to a temporary folder, since there driver and
    executors are one process. On any cluster, ``local-cluster`` included, an unset folder is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or _local_folders.get(context.applicationId)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="starfold-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


#: Folder below the application's that scratch goes to.
_scope: ContextVar[str] = ContextVar("scratch scope", default="")


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """Scratch written meanwhile goes to a folder ``name`` of its own, which :func:`drop_scratch` can delete alone."""
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier job has written."""
    parts = [shared_dir(spark), spark.sparkContext.applicationId, _scope.get(), f"{label}-{uuid.uuid4().hex[:12]}"]
    return "/".join(filter(None, parts))


def drop_scratch(spark: SparkSession, scope: str = "") -> None:
    """Delete what this application (or one ``scope`` of it) wrote to the shared folder; its results can no longer be read."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(filter(None, [shared_dir(spark), spark.sparkContext.applicationId, scope])))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Codec of the tables of layers and models: a fifth to a third smaller than by Spark's own choice.
CODEC = "zstd"


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike a cache the result survives the loss of executors, and later jobs
    prune its columns. ``codec``: the session's, unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Application id -> the rows at a time that its session was set to.
_given_rows: dict[str, str] = {}


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that run meanwhile hand Python at most ``most`` rows at a time; fewer, if the session is set to fewer.

    Spark counts rows, not bytes: ten thousand whole texts are tens of MB, which a task
    holds several times over, in Python and beside the JVM's heap.
    """
    before = spark.conf.get(_ARROW_ROWS)
    if not 0 < int(before) <= most:
        spark.conf.set(_ARROW_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def set_arrow_rows(spark: SparkSession, most: int | None) -> None:
    """As :func:`arrow_rows`, from now on: for results that are computed after they are returned. None: as the session was set."""
    given = _given_rows.setdefault(spark.sparkContext.applicationId, spark.conf.get(_ARROW_ROWS))
    spark.conf.set(_ARROW_ROWS, given if most is None or 0 < int(given) <= most else str(most))


def collected(spark: SparkSession, reports: Iterable[DataFrame], label: str, at_once: int = 4) -> DataFrame:
    """The rows of all ``reports``, which share one schema, written in jobs of ``at_once`` reports and read back as one table.

    One plan over many reports holds every broadcast of them on the driver at the same time; here
    those of a job can go before the next one begins.
    """
    path, schema, reports = scratch_path(spark, label), None, iter(reports)
    while batch := list(islice(reports, at_once)):
        rows = reduce(DataFrame.unionByName, batch)
        rows.write.mode("append").parquet(path)
        schema = rows.schema
    return spark.read.schema(schema).parquet(path)
