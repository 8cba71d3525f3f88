"""The reference-size warehouse: known row counts, known KPI figures, agreement of the three layouts."""

import glob

import pytest
from fixtures import base_oltp, reference_oltp
from pyspark.sql import functions as F

from starfold.operators.reconcile import reconcile
from starfold.plans.increment import increment
from starfold.plans.kpi import COLUMNS, kpi_report, load_results, write_report
from starfold.plans.questions import QUESTIONS, ask_dimensional, ask_oltp, ask_snow, ask_star, build_aggregate, refresh_aggregate
from starfold.plans.warehouse import Warehouse
from starfold.schemas import OLTP, SNOW, STAR, validate_layer
from starfold.sources import conform, inline_table

STORED = ("detalle_pedido", "envios", "costes_logisticos", "lotes_origen", "lotes", "cosechas", "cultivos", "pedidos",
          "calibres", "costes_lote", "clientes", "parcelas")

ROWS = {
    "fincas": 60, "parcelas": 120, "campanias": 60, "cultivos": 60, "cosechas": 180, "lotes_origen": 180, "lotes": 180,
    "controles_calidad": 180, "calibres": 720, "certificados": 180, "incidencias_calidad": 36, "clientes": 60,
    "contratos": 60, "pedidos": 360, "detalle_pedido": 360, "tarifas": 240, "transitarios": 60, "puertos": 60,
    "rutas_logisticas": 120, "envios": 360, "aduanas": 180, "incidencias_envio": 45, "facturas": 180, "cobros": 180,
    "costes_lote": 180, "costes_logisticos": 360, "tipos_cambio": 60,
}
TARGETS = [("Citricos", 35000), ("Frutas", 45000), ("Frutos rojos", 60000), ("Hortalizas", 85000)]

# The published report at 180 order lines.
REPORT = """familia_producto;ingresos_reales;costes_totales;margen_total;objetivo;pct_margen;pct_objetivo
Hortalizas;47250.78;13627.31;33623.47;85000;71,1596083705;55,5891529412
Frutos rojos;41898.54;6681.81;35216.73;60000;84,0524037353;69,8309
Citricos;15171.72;4627.1;10544.62;35000;69,5018099464;43,3477714286
Frutas;14037.81;1940.94;12096.87;45000;86,1734843255;31,1951333333
"""


@pytest.fixture(scope="module")
def base(spark):
    return Warehouse(spark, lambda t: base_oltp(spark, t), STORED)


@pytest.fixture(scope="module")
def full(spark):
    return Warehouse(spark, lambda t: reference_oltp(spark, t), STORED)


@pytest.fixture(scope="module")
def targets(spark):
    return inline_table(spark, TARGETS, "familia_producto string, objetivo_ingresos int")


def test_oltp_row_counts(full):
    assert {name: full.oltp[name].count() for name in full.oltp} == ROWS


def test_oltp_tables_have_the_declared_columns(full):
    for name, table in OLTP.items():
        conform(full.oltp[name], table.schema)


def test_no_declared_rule_is_broken(full):
    broken = validate_layer({name: full.oltp[name] for name in full.oltp})
    assert broken.limit(5).collect() == []


def test_layer_columns_follow_the_declaration(base):
    for layer, declared in ((base.star, STAR), (base.snow, SNOW)):
        for name, table in declared.items():
            assert [c for c in layer[name].columns if c != "anio_pedido"] == table.names, name


def test_dimension_sizes(base):
    sizes = {name: base.star[name].count() for name in base.star}
    assert sizes == {"dim_tiempo": 180, "dim_campania": 60, "dim_cliente": 60, "dim_geografia": 6, "dim_finca": 120,
                     "dim_producto": 60, "dim_calidad": 180, "dim_logistica": 120, "fact_exportaciones": 180}
    assert base.snow["dim_familia_producto"].count() == 4
    assert base.snow["fact_exportaciones"].count() == 180
    assert base.star["dim_tiempo"].filter("es_festivo").count() == 52


@pytest.mark.parametrize("question, groups", [("a1", 180), ("a2", 60), ("a3", 60), ("a4", 60), ("a5", 18), ("a6", 180), ("a7", 4)])
def test_layouts_agree(base, question, groups):
    q = QUESTIONS[question]
    star, snow = ask_star(base.star, q), ask_snow(base.snow, q)
    assert star.count() == groups and star.exceptAll(snow).count() == 0
    oltp = ask_oltp(base.oltp, q, base.hot_join_keys())
    # A line may differ by half a cent per rounded measure; no group holds more than 90 lines.
    assert reconcile(oltp, star, q.keys, [*q.sums, *q.means], tolerance=1.0).count() == 0
    one, two = base.spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint")), F.xxhash64(F.lit(2).cast("bigint"))).first()
    base.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = ask_oltp(base.oltp, q, {"lote_id": [one, two], "pedido_id": [two], "cliente_id": [one], "ruta_id": [two]})
        assert salted.exceptAll(oltp).count() == 0 and salted.count() == groups
    finally:
        base.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


@pytest.mark.parametrize("question", ["a2", "a4", "a5"])
def test_pre_aggregation_changes_nothing(base, question):
    q, fact = QUESTIONS[question], base.star["fact_exportaciones"]
    assert ask_dimensional(fact, base.star, q, pre_aggregate=True).exceptAll(ask_star(base.star, q)).count() == 0


def test_published_report(spark, base, targets, tmp_path):
    report = kpi_report(ask_star(base.star, QUESTIONS["a7"]), targets)
    write_report(report, str(tmp_path / "kpi"))
    (path,) = glob.glob(str(tmp_path / "kpi" / "*.csv"))
    assert open(path, encoding="utf-8").read() == REPORT
    stored = load_results(report.filter(F.lit(False)), report)
    assert load_results(stored, report).exceptAll(report).count() == 0 and stored.columns == COLUMNS


def test_family_without_target(base, targets):
    report = kpi_report(ask_star(base.star, QUESTIONS["a7"]), targets.filter("familia_producto <> 'Frutas'"))
    row = report.filter("familia_producto = 'Frutas'").first()
    assert row.objetivo == 0 and row.pct_objetivo is None


@pytest.fixture(scope="module")
def loaded(base, full):
    """Fact and calendar after the increment of 180 orders has been applied twice."""
    dims, fact = {n: base.star[n] for n in base.star if n.startswith("dim_")}, base.star["fact_exportaciones"]
    added = []
    for _ in range(2):
        days, lines = increment(full.oltp, dims, fact, full.oltp["pedidos"])
        added.append((days.count(), lines.count()))
        dims["dim_tiempo"] = dims["dim_tiempo"].unionByName(days)
        fact = fact.unionByName(lines)
    return added, dims, fact


def test_increment_is_idempotent(loaded):
    added, dims, fact = loaded
    assert added == [(180, 180), (0, 0)]
    assert fact.count() == 360 and dims["dim_tiempo"].count() == 360
    assert dims["dim_tiempo"].select("tiempo_sk").distinct().count() == 360


def test_kpi_after_increment(loaded):
    _, dims, fact = loaded
    got = {r.familia_producto: tuple(map(str, r[1:])) for r in ask_dimensional(fact, dims, QUESTIONS["a7"]).collect()}
    assert got == {
        "Hortalizas": ("94501.56", "27270.46", "67231.10"), "Frutos rojos": ("83797.08", "13355.62", "70441.46"),
        "Citricos": ("30343.44", "9270.23", "21073.21"), "Frutas": ("28075.62", "3873.83", "24201.79")}


@pytest.mark.parametrize("question, groups", [("a1", 360), ("a2", 60), ("a3", 60), ("a4", 60), ("a5", 18)])
def test_group_counts_after_increment(loaded, question, groups):
    _, dims, fact = loaded
    assert ask_dimensional(fact, dims, QUESTIONS[question]).count() == groups


def test_aggregate_refresh(base, loaded):
    _, dims, fact = loaded
    tables = {**dims, "fact_exportaciones": fact}
    old = build_aggregate(tables, fact.filter("pedido_id <= 180"))
    refreshed = refresh_aggregate(old, build_aggregate(tables, fact.filter("pedido_id > 180")))
    assert refreshed.exceptAll(build_aggregate(tables)).count() == 0 and refreshed.count() == 360


def test_saved_databases_answer_sql(spark, base, tmp_path):
    base.save(str(tmp_path), {
        "olap_star": ["fact_exportaciones", "dim_tiempo", "dim_producto"], "oltp_calidad": ["calibres"],
        "olap_snow": ["dim_producto", "dim_familia_producto"]})
    by_quarter = spark.sql("""
        SELECT t.trimestre, SUM(f.importe_neto) AS ingresos FROM olap_star.fact_exportaciones f
        JOIN olap_star.dim_tiempo t ON t.tiempo_sk = f.tiempo_sk GROUP BY t.trimestre""")
    total = base.star["fact_exportaciones"].agg(F.sum("importe_neto")).first()[0]
    assert by_quarter.count() == 4 and by_quarter.agg(F.sum("ingresos")).first()[0] == total
    families = spark.sql("""
        SELECT fp.familia_producto, COUNT(*) AS n FROM olap_snow.dim_producto p
        JOIN olap_snow.dim_familia_producto fp ON fp.familia_sk = p.familia_sk GROUP BY fp.familia_producto""")
    assert {r.familia_producto: r.n for r in families.collect()} == {"Hortalizas": 30, "Frutas": 5, "Frutos rojos": 15, "Citricos": 10}
    top = spark.sql("""
        SELECT calibre, COUNT(*) AS n FROM (SELECT lote_id, calibre, ROW_NUMBER() OVER (
          PARTITION BY lote_id ORDER BY kilos_calibre DESC, calibre) AS rn FROM oltp_calidad.calibres) WHERE rn = 1 GROUP BY calibre""")
    assert {r.calibre: r.n for r in top.collect()} == {"S": 45, "M": 45, "L": 45, "XL": 45}
    for database in ("olap_star", "oltp_calidad", "olap_snow"):
        spark.sql(f"DROP DATABASE {database} CASCADE")
