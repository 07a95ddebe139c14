"""Metric layer: named dimensions and measures over one source, grouped on demand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class MetricView:
    source: DataFrame
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Column]

    def query(
        self,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: Column | str | None = None,
    ) -> DataFrame:
        """Evaluate measures per combination of dimensions; no dimensions gives one total row."""
        unknown = [d for d in dimensions if d not in self.dimensions]
        unknown += [m for m in measures if m not in self.measures]
        if unknown:
            raise KeyError(f"not in the metric view: {', '.join(unknown)}")
        rows = self.source if where is None else self.source.filter(where)
        return rows.groupBy(*(self.dimensions[d].alias(d) for d in dimensions)).agg(
            *(self.measures[m].alias(m) for m in measures)
        )


def daily_sales_metrics(fact: DataFrame) -> MetricView:
    """The sales metric view. Its names and formulas are fixed values."""
    return MetricView(
        source=fact,
        dimensions={
            "Invoice Date": F.col("invoice_date_key"),
            "Stock Item Key": F.col("stock_item_key"),
            "Customer Key": F.col("customer_key"),
        },
        measures={
            "Transaction Count": F.count(F.lit(1)),
            "Quantity Sold": F.sum("quantity"),
            "Gross Revenue": F.sum("total_including_tax"),
            "Profit": F.sum("profit"),
        },
    )
