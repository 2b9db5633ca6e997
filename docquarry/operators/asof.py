"""As-of joins: to each row of one table the latest row of another at or before it, within a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, by: str, at: str) -> DataFrame:
    """left with the columns of right's latest row with the same ``by`` and an ``at`` that is not later; null if none is.

    One shuffle on ``by`` and one sort: both tables are one, in order of time, and each row of left looks back to the
    last row of right. Of right's rows at one time, the greatest by its other columns counts. Rows with a null ``by``
    or ``at`` have no match; the columns of the tables have to differ but for these two.
    """
    names = [c for c in right.columns if c not in (by, at)]
    mine = left.select(F.col(by), F.col(at), F.lit(1).alias("side"), F.struct(*left.columns).alias("row"), F.lit(None).cast(right.select(F.struct(at, *names)).schema[0].dataType).alias("other"))
    theirs = right.where(F.col(by).isNotNull() & F.col(at).isNotNull()).select(F.col(by), F.col(at), F.lit(0).alias("side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("row"), F.struct(at, *names).alias("other"))
    back = Window.partitionBy(by).orderBy(at, "side", "other").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = mine.unionByName(theirs).withColumn("latest", F.last("other", ignorenulls=True).over(back)).where("side = 1")
    known = F.col(by).isNotNull() & F.col(at).isNotNull()
    return met.select("row.*", *[F.when(known, F.col("latest")[c]).alias(c) for c in names], F.when(known, F.col("latest")[at]).alias(f"{at}_matched"))
