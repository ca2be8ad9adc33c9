"""Running totals over numbered groups without one task for all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: So many numbers are summed within one window.
SPAN = 4096


def running_totals(groups: DataFrame, number: str, value: str) -> DataFrame:
    """groups with `before`: the sum of `value` over all smaller numbers (`number` is a distinct non-negative int).

    Two levels: sums over spans of SPAN numbers, totals of those before each span, then a window within a span.
    """
    span = F.floor(F.col(number) / SPAN).alias("span")
    spans = groups.groupBy(span).agg(F.sum(value).alias("total"))
    earlier = (spans.select("span", F.coalesce(F.sum("total").over(
        Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier")))
    inside = Window.partitionBy("span").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return (groups.withColumn("span", span).join(earlier, "span")
            .withColumn("before", F.col("earlier") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("span", "earlier"))
