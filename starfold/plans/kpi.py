"""Revenue against target by product family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import dec, number_text, safe_ratio
from ..operators.lookup import lookup
from ..operators.reshape import add_constant
from ..operators.upsert import upsert
from ..sinks.report import write_csv_report

COLUMNS = ["familia_producto", "ingresos_reales", "costes_totales", "margen_total", "objetivo", "pct_margen",
           "pct_objetivo"]


def kpi_report(families: DataFrame, targets: DataFrame) -> DataFrame:
    """Target looked up by family (0 when it has none), margin and target percentages, best first.

    A family without a target has no target percentage.
    """
    with_target = lookup(families, targets, {"familia_producto": "familia_producto"},
                         {"objetivo_ingresos": ("objetivo", 0)})
    hundred = add_constant(with_target, "cien", 100, "decimal(3,0)")
    ratios = hundred.withColumns({
        # The numerator's scale decides how many digits the quotient keeps: twelve, beside sums of any size.
        "ratio_margen": dec(safe_ratio(dec("margen_total", 38, 14), "ingresos_reales"), 28, 12),
        "ratio_objetivo": dec(safe_ratio(dec("ingresos_reales", 38, 14), dec("objetivo", 15, 0)), 28, 12),
    })
    percent = {
        "pct_margen": F.round(F.col("ratio_margen") * F.col("cien"), 10).cast("decimal(28,10)"),
        "pct_objetivo": F.round(F.col("ratio_objetivo") * F.col("cien"), 10).cast("decimal(28,10)"),
    }
    # The family breaks ties, so that equal revenues do not pile up in one sort partition.
    return ratios.withColumns(percent).select(*COLUMNS).orderBy(F.desc("ingresos_reales"), "familia_producto")


def load_results(results: DataFrame, report: DataFrame) -> DataFrame:
    return upsert(results, report, ["familia_producto"])


def write_report(report: DataFrame, path: str) -> None:
    """One semicolon CSV with DOS line ends, a row per family; amounts with a point, percentages with a comma."""
    amounts = {c: number_text(c, 2) for c in ("ingresos_reales", "costes_totales", "margen_total")}
    percents = {c: number_text(c, 10, symbol=",") for c in ("pct_margen", "pct_objetivo")}
    write_csv_report(report, path, masks={**amounts, **percents},
                     line_sep="\r\n", order_by=[F.desc("ingresos_reales"), "familia_producto"], files=1)
