"""Row numbers and running sums over a total order, without a task that sees all rows.

Rows are range-partitioned by the order into parts of about ``part_rows`` rows.  Counts or sums of the
parts, a table of rows / ``part_rows`` entries for each group, give each part its start; within a part
a window does the rest.  A group with a third of all rows is spread over many parts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.session import materialize

PART_ROWS = 500_000


def parts(df: DataFrame, order: list[str], part_rows: int = PART_ROWS, tag: str = "parts") -> DataFrame:
    """The rows, written once, with ``__part``: the number of their range in the order."""
    rows = materialize(df, tag)
    count = max(1, math.ceil(rows.count() / part_rows))
    ranged = rows.repartitionByRange(count, *order) if count > 1 else rows.coalesce(1)
    return materialize(ranged.withColumn("__part", F.spark_partition_id()), tag)


def running(df: DataFrame, order: list[str], value: Column, name: str, by: list[str] = [], part_rows: int = PART_ROWS) -> DataFrame:
    """The table with ``name``: the sum of ``value`` over the rows of the same ``by`` up to and with this one."""
    ranged = parts(df, order, part_rows).withColumn("__value", value)
    groups = [*by, "__part"]
    sums = ranged.groupBy(*groups).agg(F.sum("__value").alias("__sum"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(b).alias(f"__by_{b}") for b in by], F.col("__part").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("__part") == F.col("__of")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    inside = ranged.withColumn("__inside", F.sum("__value").over(within))
    return inside.join(starts, same).withColumn(name, F.col("__start") + F.col("__inside")).drop("__part", "__value", "__inside", "__of", "__start", *[f"__by_{b}" for b in by])


def numbered(df: DataFrame, order: list[str], name: str, by: list[str] = [], part_rows: int = PART_ROWS) -> DataFrame:
    """The table with ``name``: the number of each row, from 1, in the order of its group."""
    return running(df, order, F.lit(1).cast("long"), name, by, part_rows)


def with_row_ids(df: DataFrame, order: list[str], column: str, pattern: str) -> DataFrame:
    """Missing ids filled from the row number, such as ``record-%08d``."""
    made = numbered(df, order, "__row")
    return made.withColumn(column, F.coalesce(F.nullif(F.col(column), F.lit("")), F.format_string(pattern, "__row"))).drop("__row")
