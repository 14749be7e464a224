"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``concat([a, b]).drop_duplicates(keep=False)`` - rows whose full
    value occurs exactly once in the concatenation. One aggregation keyed by
    all columns (partial counts on the map side); null equals null as in
    pandas."""
    cols = a.columns
    return (a.unionByName(b).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
            .filter(F.col("__n") == 1).select(*cols))
