"""Delimited text reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv_report(
    df: DataFrame,
    path: str,
    sep: str = ";",
    masks: Mapping[str, Column] | None = None,
    line_sep: str = "\n",
    order_by: Sequence[Column | str] = (),
    files: int | None = None,
) -> None:
    """Overwrite ``path`` with delimited text: header, quotes only where needed, UTF-8.

    ``masks`` replace columns by their text form. ``order_by`` sorts the whole
    report, part file after part file. ``files`` asks for a number of part files,
    whatever the report's size; without it Spark writes in parallel. What leads to the
    report runs in parallel either way: only its own rows are brought together.
    """
    if files is None:
        source = df.orderBy(*order_by) if order_by else df
    elif order_by:
        source = df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by) if files > 1 else df.repartition(1).sortWithinPartitions(*order_by)
    else:
        source = df.repartition(files)
    text = source.select(*[(masks or {}).get(c, F.col(c)).alias(c) for c in df.columns])
    (
        text.write.mode("overwrite")
        .option("sep", sep).option("header", True).option("lineSep", line_sep).option("encoding", "UTF-8")
        .option("emptyValue", "")
        .csv(path)
    )
