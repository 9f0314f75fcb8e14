"""Report tables in one long form."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpi_long(sections: Iterable[tuple[str, DataFrame, str]]) -> DataFrame:
    """Stack KPI tables as ``section``, ``metric``, ``period``, ``value``.

    Each section is ``(name, table, period column)``; every other numeric column is a metric.
    """
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

    def melt(name: str, table: DataFrame, period: str) -> DataFrame:
        metrics = [c for c, kind in table.dtypes if c != period and kind.startswith(numeric)]
        values = table.select(
            F.to_date(period).alias("period"), *[F.col(f"`{m}`").cast("double").alias(m) for m in metrics]
        )
        long = values.unpivot(["period"], metrics, "metric", "value")
        return long.select(F.lit(name).alias("section"), "metric", "period", "value")

    return reduce(DataFrame.unionByName, [melt(*section) for section in sections])
