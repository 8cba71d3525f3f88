import datetime
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starfold import session
from starfold.functions.numbers import number_text
from starfold.sinks import VersionedLayer, append_rejects, read_rejects, save_database, write_csv_report, write_partitioned
from starfold.sources import conform, inline_table, read_csv_typed, read_jdbc, read_query, series


def test_typed_csv_with_locale(spark, tmp_path):
    (tmp_path / "t.csv").write_text("familia;objetivo;precio\nCitricos;35.000;1.234,5\nFrutas;x;\n", encoding="utf-8")
    got = read_csv_typed(spark, str(tmp_path / "t.csv"), "familia STRING, objetivo INT, precio DECIMAL(10,2)")
    assert [tuple(r) for r in got.collect()] == [("Citricos", 35000, Decimal("1234.50")), ("Frutas", None, None)]


def test_station_csv(spark, tmp_path):
    (tmp_path / "e.csv").write_text(
        "estacion_id,nombre_estacion,ciudad,latitud,longitud,altitud_metros,activa,fecha_instalacion\n"
        "901,Torre del Viento,Añoranza,12.345678,-1.5,77,TRUE,2011-03-09\n902,Vieja,Lugar,1.5,2,10,FALSE,1990-01-02\n", encoding="utf-8")
    from starfold.schemas import WEATHER

    got = read_csv_typed(spark, str(tmp_path / "e.csv"), WEATHER["estaciones_meteorologicas"].schema, sep=",", decimal=".", group="")
    first, second = got.collect()
    assert (first.ciudad, first.latitud, first.activa, first.fecha_instalacion) == (
        "Añoranza", Decimal("12.345678"), True, datetime.date(2011, 3, 9))
    assert second.activa is False


def test_csv_prunes_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b;c\n1;2;3\n")
    df = read_csv_typed(spark, str(tmp_path / "t.csv"), "a INT, b INT, c INT").select("b")
    assert "ReadSchema: struct<b:string>" in df._jdf.queryExecution().executedPlan().toString()


def test_report_masks_quotes_and_line_ends(spark, tmp_path):
    df = inline_table(spark, [("a;b", 1.5, 85000), ("c", 2.25, 7)], "k string, v double, n int")
    write_csv_report(df, str(tmp_path / "out"), masks={"v": number_text("v", 4, symbol=",")}, line_sep="\r\n", order_by=[F.desc("v")], files=1)
    (path,) = glob.glob(str(tmp_path / "out" / "*.csv"))
    assert open(path, newline="").read() == 'k;v;n\r\nc;2,25;7\r\n"a;b";1,5;85000\r\n'


def test_report_files(spark, tmp_path):
    for files in (1, 3):
        path = str(tmp_path / f"out{files}")
        write_csv_report(spark.range(1000), path, order_by=["id"], files=files)
        parts = sorted(glob.glob(f"{path}/*.csv"))
        assert len(parts) == files
        ids = [int(line) for part in parts for line in open(part).read().splitlines()[1:]]
        assert ids == list(range(1000)), "sorted over all part files"
    write_csv_report(spark.range(1000), str(tmp_path / "free"), order_by=["id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "free")).count() == 1000


def test_series_is_inclusive(spark):
    assert [r.g for r in series(spark, 3, 6).collect()] == [3, 4, 5, 6]


def test_read_query_takes_frames(spark):
    assert read_query(spark, "SELECT sum(g) AS s FROM {n}", n=series(spark, 1, 4)).first().s == 10


def test_conform_checks_and_orders_columns(spark):
    df = inline_table(spark, [(1, "2", 3)], "a int, b string, z int")
    assert conform(df, "b INT, a BIGINT").dtypes == [("b", "int"), ("a", "bigint")]
    with pytest.raises(ValueError, match="missing"):
        conform(df, "nope INT")


class FakeReader:
    def __init__(self):
        self.options = {}

    def format(self, name):
        self.kind = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self


class FakeSession:
    def __init__(self):
        self.read = FakeReader()


def test_jdbc_options():
    plain = read_jdbc(FakeSession(), "jdbc:x", "select 1", {"user": "u"})
    assert plain.kind == "jdbc" and plain.options["query"] == "select 1" and plain.options["user"] == "u"
    sliced = read_jdbc(FakeSession(), "jdbc:x", "select 1", None, "id", 0, 100, 8)
    assert sliced.options["dbtable"] == "(select 1) q" and sliced.options["numPartitions"] == 8 and "query" not in sliced.options
    with pytest.raises(ValueError):
        read_jdbc(FakeSession(), "jdbc:x", "select 1", partition_column="id")


def test_rejects_keep_runs_apart(spark, tmp_path):
    for run in ("r1", "r2"):
        append_rejects(spark.range(3), str(tmp_path / "log"), run)
    counts = spark.read.parquet(str(tmp_path / "log")).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in counts} == {"r1": 3, "r2": 3}


def test_versions(spark, tmp_path):
    layer = VersionedLayer(spark, str(tmp_path / "layer"))
    assert layer.current() is None
    with pytest.raises(FileNotFoundError):
        layer.read("t")
    layer.publish({"t": spark.range(3), "u": spark.range(1)})
    layer.publish(append={"t": spark.range(3, 5)})
    assert layer.current() == 2 and layer.read("t").count() == 5 and layer.read("u").count() == 1
    assert layer.read("t", version=1).count() == 3
    layer.publish({"t": layer.read("t")})
    assert layer.read("t").count() == 5 and layer.current() == 3


def test_failed_load_stays_invisible(spark, tmp_path):
    layer = VersionedLayer(spark, str(tmp_path / "layer"))
    layer.publish({"t": spark.range(3)})
    with pytest.raises(Exception):
        layer.publish({"t": spark.range(9), "bad": spark.range(1).select(F.raise_error(F.lit("boom")))})
    assert layer.current() == 1 and layer.read("t").count() == 3
    layer.publish({"t": spark.range(4)})
    assert layer.read("t").count() == 4


def test_empty_and_torn_loads(spark, tmp_path):
    layer = VersionedLayer(spark, str(tmp_path / "layer"))
    rows = spark.range(10).withColumn("p", (F.col("id") % 2).cast("int"))
    layer.publish({"t": rows.limit(0), "u": rows.limit(0)}, partition_by={"t": ["p"]})
    assert layer.read("t").count() == 0 and layer.read("u").columns == ["id", "p"]
    layer.publish(append={"t": rows}, partition_by={"t": ["p"]})
    layer.publish(append={"t": rows.limit(0)}, partition_by={"t": ["p"]})
    assert layer.read("t").columns == ["id", "p"] and layer.read("t").count() == 10
    torn = tmp_path / "layer" / "v000004"
    torn.mkdir()
    (torn / "manifest.json").write_text("")
    assert layer.current() == 3 and layer.read("t").count() == 10, "a torn manifest is not a version"
    assert layer.publish(append={"t": rows}) == 5 and layer.read("t").count() == 20
    append_rejects(rows.limit(0), str(tmp_path / "log"), "r1")
    assert read_rejects(spark, str(tmp_path / "log"), rows.schema).count() == 0


def test_many_loads_are_one_scan(spark, tmp_path):
    layer = VersionedLayer(spark, str(tmp_path / "layer"))
    for _ in range(25):
        layer.publish(append={"t": spark.range(1)})
    table = layer.read("t")
    assert table.count() == 25 and table._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_partitioned_write_makes_few_files(spark, tmp_path):
    df = spark.range(1000).repartition(16).withColumn("p", F.col("id") % 3)
    write_partitioned(df, str(tmp_path / "out"), ["p"])
    assert len(glob.glob(str(tmp_path / "out" / "p=*" / "*.parquet"))) == 3


class FakeContext:
    """A context without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.applicationId, self.folder = master, f"app-{master}", None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeApplication:
    def __init__(self, master):
        self.sparkContext = FakeContext(master)


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeApplication("spark://host:7077"))


def test_local_session_without_shared_folder_gets_one():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeApplication("local-cluster[2,1,1024]"))
    local = FakeApplication("local[4]")
    folder = session.shared_dir(local)
    assert session.shared_dir(local) == folder == local.sparkContext.folder


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    a = spark.range(500).withColumn("v", F.col("id") * 2)
    save_database(spark, "capa", str(tmp_path / "capa"), {"a": a, "b": a}, buckets={"a": (4, "id"), "b": (4, "id")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = read_query(spark, "SELECT a.id, b.v FROM capa.a JOIN capa.b ON a.id = b.id")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text and joined.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.sql("DROP DATABASE capa CASCADE")


def test_written_tables_live_in_the_shared_folder_until_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    kept = session.written(spark.range(3), "x")
    folder = tmp_path / spark.sparkContext.applicationId
    assert kept.count() == 3 and str(folder) in kept.inputFiles()[0]
    session.drop_scratch(spark)
    assert not folder.exists()


def test_the_kpi_file_has_dos_line_ends(spark, tmp_path):
    from starfold.plans.kpi import COLUMNS, write_report

    values = {c: "familia" if c == "familia_producto" else 12 if c == "objetivo" else Decimal("1234.5") for c in COLUMNS}
    kinds = {c: "string" if c == "familia_producto" else "int" if c == "objetivo" else "decimal(28,10)" for c in COLUMNS}
    write_report(spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} {k}" for c, k in kinds.items())), str(tmp_path / "kpi"))
    (part,) = glob.glob(str(tmp_path / "kpi" / "part-*"))
    text = open(part, "rb").read()
    assert text.count(b"\r\n") == 2 == text.count(b"\n") and text.startswith(b"familia_producto;")
