"""Rates and shares of a report sheet.

A share divides by the total of its scope: the whole sheet of one request
(W1) or one device class of one request (W2).  The totals are a grouped
aggregate joined back, so rows are summed before they are shuffled and no task
ever holds a whole sheet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adinsight.functions.columns import ratio_sql

# The metric columns of every sheet, in report order.
METRIC_COLUMNS = [
    "impressions", "Percentage_Impression_share",
    "clicks", "Percentage_Click_share", "Percentage_CTR",
    "conversions", "Percentage_Conversion_share", "Percentage_CVR",
]


def with_metrics(df: DataFrame, dims: Sequence[str],
                 share_by: Sequence[str] = ("request_id",),
                 extra: Sequence[str] = (),
                 totals_from: DataFrame | None = None) -> DataFrame:
    """Add CTR, CVR and the three shares; select the report columns.

    ``extra`` are SQL expressions (e.g. sort helpers) kept after the report
    columns.  ``totals_from`` may give the rows ``df`` was summed from (same
    scope totals): the totals then no longer wait for ``df``'s aggregate.
    """
    share_by = list(share_by)
    keep = ["request_id"] + [c for c in share_by if c != "request_id" and c not in dims]
    totals = (totals_from if totals_from is not None else df).groupBy(*share_by).agg(
        F.sum("impressions").alias("_t_imp"),
        F.sum("clicks").alias("_t_clk"),
        F.sum("conversions").alias("_t_conv"))
    return df.join(totals, share_by, "inner").selectExpr(
        *keep, *dims,
        "impressions",
        f"{ratio_sql('impressions', '_t_imp')} AS Percentage_Impression_share",
        "clicks",
        f"{ratio_sql('clicks', '_t_clk')} AS Percentage_Click_share",
        f"{ratio_sql('clicks', 'impressions')} AS Percentage_CTR",
        "conversions",
        f"{ratio_sql('conversions', '_t_conv')} AS Percentage_Conversion_share",
        f"{ratio_sql('conversions', 'impressions')} AS Percentage_CVR",
        *extra,
    )
