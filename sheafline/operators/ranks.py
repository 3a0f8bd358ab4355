"""Row numbers within a key without one task a key.

The order column is cut into stretches of equal width. Rows are numbered inside (key, stretch); the counts of the stretches, a table smaller by the
width, give each stretch its offset. A key that a third of all rows share is spread over its stretches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, key: str, order: str, out: str = "n", width: int = 100_000) -> DataFrame:
    """Adds ``out`` = 1, 2, ... by ``order`` (a whole number, unique within the key). Null orders come first in their key, null keys are a key of their own."""
    cut = df.withColumn("__s", F.floor(F.col(order) / width))
    counts = cut.groupBy(key, "__s").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(key).orderBy(F.asc_nulls_first("__s")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__o", F.coalesce(F.sum("__c").over(before), F.lit(0))).filter("__o > 0").select(F.col(key).alias("__k"), F.col("__s").alias("__t"), "__o")
    inside = cut.withColumn("__r", F.row_number().over(Window.partitionBy(key, "__s").orderBy(order)))
    joined = inside.join(offsets, F.col(key).eqNullSafe(F.col("__k")) & F.col("__s").eqNullSafe(F.col("__t")), "left")
    return joined.withColumn(out, F.col("__r") + F.coalesce("__o", F.lit(0))).drop("__s", "__r", "__k", "__t", "__o")


def runs(df: DataFrame, key: str, order: str, same: list[str], width: int = 100_000) -> DataFrame:
    """(key, run, first, last, rows, first_order, last_order, and the columns ``same``): rows of a key in order, put together while the columns ``same`` do not change.

    ``order`` is a whole number, unique within the key. Rows meet their forerunner, and the beginnings of runs the next ones, by joins on their numbers, so no key is one task.
    """
    n = numbered(df.select(key, order, *same), key, order, "__n", width)
    before = n.select(F.col(key).alias("__k"), (F.col("__n") + 1).alias("__m"), F.struct(*same).alias("__before"))
    joined = n.join(before, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__n") == F.col("__m")), "left")
    fresh = joined.filter(F.col("__m").isNull() | ~F.col("__before").eqNullSafe(F.struct(*same))).select(key, "__n", F.col(order).alias("first_order"), *same)
    fresh = numbered(fresh, key, "__n", "run", width)
    following = fresh.select(F.col(key).alias("__k"), (F.col("run") - 1).alias("__r"), F.col("__n").alias("__next"))
    totals = df.groupBy(key).agg(F.count("*").alias("__all")).withColumnRenamed(key, "__t")
    spans = fresh.join(following, F.col(key).eqNullSafe(F.col("__k")) & (F.col("run") == F.col("__r")), "left").join(totals, F.col(key).eqNullSafe(F.col("__t")))
    spans = spans.withColumn("rows", F.coalesce("__next", F.col("__all") + 1) - F.col("__n"))
    ends = n.select(F.col(key).alias("__e"), F.col("__n").alias("__at"), F.col(order).alias("last_order"))
    out = spans.join(ends, F.col(key).eqNullSafe(F.col("__e")) & (F.col("__n") + F.col("rows") - 1 == F.col("__at")))
    return out.select(key, "run", "rows", "first_order", "last_order", *same)
