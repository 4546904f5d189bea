"""Scalar subqueries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame -- an aggregate without grouping
    such as a count, a maximum or a cut-off -- to every row of ``df``.

    An uncorrelated scalar subquery: it is computed once and is a constant in
    the plan of ``df``, which needs no join. It is named once and taken apart
    above, so the plan holds it once whatever the number of columns."""
    one = one_row.select(F.struct(*one_row.columns).alias("_one")).scalar()
    return df.withColumn("_one", one).select("*", *[F.col("_one")[c].alias(c) for c in one_row.columns]).drop("_one")
