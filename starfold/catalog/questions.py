"""The analytical questions over each layout."""

from __future__ import annotations


from pyspark.sql import DataFrame

from ..operators.reconcile import reconcile, reconcile_many
from ..plans.kpi import kpi_report
from ..plans.questions import (
    QUESTIONS, ask_dimensional, ask_oltp, ask_snow, ask_star, build_aggregate, dimensional_lines, fact_measure, line_measure, measured,
    oltp_lines, refresh_aggregate,
)
from ..plans.snow import products_with_family
from ..session import written
from ..sources.generated import inline_table
from .registry import Source, query
from .sql import half_up_int, mean6, with_views

# measure -> (expression, decimals of the integer form) as stored on the fact and as computed on the line
_FACT = {
    "neto": "neto", "kilos": "kilos", "coste_producto": "coste_producto", "coste_logistico": "coste_logistico",
    "coste_total": "coste_total", "margen": "margen",
}
_LINE = {"neto": "neto", "kilos": "kilos", "coste_producto": "cp", "coste_logistico": "cl", "coste_total": "cp + cl",
         "margen": "neto - cp - cl"}
_FACT_MEANS = {"precio_kg": ("precio4", 4), "dias": ("dias", 0),
               "logistico_kg": (half_up_int("coste_logistico", "kilos", 15), 15)}
_LINE_MEANS = {"precio_kg": (half_up_int("neto", "kilos", 13), 13), "dias": ("dias", 0),
               "logistico_kg": ("CAST(logistico_kg * 10000 AS HUGEINT)", 4)}


def question_body(name: str, stored: bool) -> str:
    q = QUESTIONS[name]
    sums, means = (_FACT, _FACT_MEANS) if stored else (_LINE, _LINE_MEANS)
    columns = [*q.keys]
    columns += [f"CAST(SUM({sums[m]}) AS DECIMAL(24,2)) AS {n}" for n, m in q.sums.items()]
    columns += [f"{mean6(*means[m])} AS {n}" for n, m in q.means.items()]
    view = "hechos" if stored else "lineas"
    return f"SELECT {', '.join(columns)} FROM {view} GROUP BY {', '.join(q.keys)}"


def question_sql(name: str, stored: bool) -> str:
    return with_views("hechos" if stored else "lineas", question_body(name, stored))


for _name in ("a1", "a2", "a3", "a4", "a5"):
    query(f"{_name}_oltp", question_sql(_name, stored=False))(
        lambda s, n=_name: ask_oltp(s.warehouse.oltp, QUESTIONS[n], s.warehouse.hot_join_keys(), s.warehouse.chain))
    query(f"{_name}_star", question_sql(_name, stored=True))(lambda s, n=_name: ask_star(s.warehouse.star, QUESTIONS[n]))
    query(f"{_name}_snow", question_sql(_name, stored=True))(lambda s, n=_name: ask_snow(s.warehouse.snow, QUESTIONS[n]))


@query("a2_pre_aggregated", question_sql("a2", stored=True))
def margin_by_farm_pre_aggregated(s: Source):
    """The plan taken when dimensions are too large to broadcast: aggregate by key, then join."""
    star = s.warehouse.star
    return ask_dimensional(star["fact_exportaciones"], star, QUESTIONS["a2"], pre_aggregate=True)


@query("a6_quarterly_aggregate", question_sql("a6", stored=True))
def quarterly_aggregate(s: Source):
    return build_aggregate(s.warehouse.star)


@query("a6_incremental_refresh", question_sql("a6", stored=True))
def incremental_refresh(s: Source):
    """The aggregate of the first years, refreshed with that of the later ones."""
    star = s.warehouse.star
    fact = star["fact_exportaciones"]
    old = build_aggregate(star, fact.filter("anio_pedido < 1999"))
    return refresh_aggregate(old, build_aggregate(star, fact.filter("anio_pedido >= 1999")))


@query("a7_family_kpi", question_sql("a7", stored=True))
def family_kpi(s: Source):
    return ask_star(s.warehouse.star, QUESTIONS["a7"])


_MEASURES = ["ingresos", "costeproducto", "costelogistico", "margen"]
_RECONCILED = " UNION ALL ".join(
    f"SELECT {', '.join('a.' + k for k in QUESTIONS['a1'].keys)}, 'differs' AS estado, '{m}' AS medida, "
    f"CAST(a.{m} AS DECIMAL(28,6)) AS valor_a, CAST(b.{m} AS DECIMAL(28,6)) AS valor_b "
    f"FROM a JOIN b USING ({', '.join(QUESTIONS['a1'].keys)}) WHERE a.{m} <> b.{m}" for m in _MEASURES)


@query("a8_reconcile", with_views(
    "hechos", f"SELECT * FROM (WITH a AS ({question_body('a1', False)}), b AS ({question_body('a1', True)}) {_RECONCILED})"))
def reconcile_models(s: Source):
    """Where rounding per line makes the star differ from the OLTP answer."""
    w = s.warehouse
    oltp = ask_oltp(w.oltp, QUESTIONS["a1"], w.hot_join_keys(), w.chain)
    return reconcile(oltp, ask_star(w.star, QUESTIONS["a1"]), QUESTIONS["a1"].keys, _MEASURES)


_THREE = " UNION ALL ".join(
    f"SELECT {', '.join('a.' + k for k in QUESTIONS['a1'].keys)}, 'differs' AS estado, '{m}' AS medida, CAST(a.{m} AS DECIMAL(28,6)) AS valor_oltp, "
    f"CAST(b.{m} AS DECIMAL(28,6)) AS valor_star, CAST(b.{m} AS DECIMAL(28,6)) AS valor_snow "
    f"FROM a JOIN b USING ({', '.join(QUESTIONS['a1'].keys)}) WHERE a.{m} <> b.{m}" for m in _MEASURES)


@query("a8_three_models", with_views(
    "hechos", f"SELECT * FROM (WITH a AS ({question_body('a1', False)}), b AS ({question_body('a1', True)}) {_THREE})"))
def three_models(s: Source):
    """Where the three models differ, in one aggregation over the lines of all of them."""
    return reconcile_many(lines_of_models(s), QUESTIONS["a1"].keys, _MEASURES)


def lines_of_models(s: Source) -> dict[str, DataFrame]:
    w, q = s.warehouse, QUESTIONS["a1"]
    snow = {**w.snow, "dim_producto": written(products_with_family(w.snow), "products")}
    return {
        "oltp": measured(oltp_lines(w.oltp, q, w.hot_join_keys(), w.chain), q, line_measure),
        "star": measured(dimensional_lines(w.star["fact_exportaciones"], w.star, q), q, fact_measure),
        "snow": measured(dimensional_lines(snow["fact_exportaciones"], snow, q), q, fact_measure)}


#: Targets by family; one family has none.
TARGETS = [("ECONOMY", 300000000), ("SMALL", 250000000), ("MEDIUM", 200000000), ("LARGE", 350000000), ("PROMO", 150000000)]
_TARGET_ROWS = ", ".join(f"('{f}', {t})" for f, t in TARGETS)


KPI_SQL = with_views("hechos", f"""
    SELECT familia_producto, ingresos_reales, costes_totales, margen_total, objetivo,
      CAST(CAST(sign(margen_total) * ((2 * CAST(abs(margen_total) * 100 AS HUGEINT) * 1000000000000 + CAST(ingresos_reales * 100 AS HUGEINT))
        // (2 * CAST(ingresos_reales * 100 AS HUGEINT))) AS DECIMAL(18,0)) * CAST(0.0000000001 AS DECIMAL(11,10)) AS DECIMAL(28,10)) AS pct_margen,
      CASE WHEN objetivo > 0 THEN CAST(CAST((2 * CAST(ingresos_reales * 100 AS HUGEINT) * 1000000000000 + CAST(objetivo AS HUGEINT) * 100)
        // (2 * CAST(objetivo AS HUGEINT) * 100) AS DECIMAL(18,0)) * CAST(0.0000000001 AS DECIMAL(11,10)) AS DECIMAL(28,10)) END AS pct_objetivo
    FROM (SELECT k.*, COALESCE(o.objetivo_ingresos, 0) AS objetivo FROM ({question_body('a7', True)}) k
      LEFT JOIN (VALUES {_TARGET_ROWS}) o(familia_producto, objetivo_ingresos) USING (familia_producto))""")


@query("d19_kpi_report", KPI_SQL)
def kpi(s: Source):
    targets = inline_table(s.spark, TARGETS, "familia_producto string, objetivo_ingresos int")
    return kpi_report(ask_star(s.warehouse.star, QUESTIONS["a7"]), targets)
