"""Classes of records whose contents are equal, found by range partitioning and external sorting.

Both "duplicates hidden by formatting" and "visually identical text" end in the same question:
which records carry the same full key?  :func:`classes` answers it without ever holding a group
in memory, and :func:`pairs` expands classes into pairs where a caller needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.session import materialize

#: Rows of one hash value that one task may get; more are spread over several ranges.
RANGE_ROWS = 200_000
#: Members of one class that one side of a pair task may get.
PAIR_ROWS = 512
#: Members of a class from which its size is broadcast rather than joined by a shuffle.
HOT_ROWS = 100_000


def classes(df: DataFrame, group: list[str], member: str, key: str, carry: list[str] = [], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``group`` + ``member`` + ``carry`` + class_id: the least member with the same full ``key``.

    Rows are range-partitioned by the 64-bit hash of (group, key) and sorted by hash, key and
    member with Spark's external sort; runs of equal full keys are then adjacent and one scan
    labels them.  The hash only orders the rows; equality is decided on the whole key.

    Hot keys: hashes with more than ``range_rows`` rows are counted first (8 bytes a row, combined
    before the shuffle); at most rows / ``range_rows`` such hashes exist, so their list is small
    and joins by broadcast.  Their rows get a salt, runs are labelled within each salted range,
    and the few run heads are then merged by a second sort on the full key.

    Null keys belong to no class and are dropped; repeated (group, member) rows stay repeated.
    """
    # The keys are read by the count, by the sampling of the ranges and by the sort: make them once.
    rows = materialize(
        df.where(F.col(key).isNotNull() & F.col(member).isNotNull()).select(
            *group, member, *carry, F.col(key).alias("__key"), F.xxhash64(*group, key).alias("__h")
        ),
        "keys",
    )
    hot = (
        rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > range_rows)
        .select("__h", F.ceil(F.col("__n") / range_rows).cast("int").alias("__parts"))
    )
    hot_rows = hot.collect()  # at most rows / range_rows pairs of numbers
    if hot_rows:
        spark = df.sparkSession
        hot = spark.createDataFrame(hot_rows, "__h long, __parts int")
        rows = rows.join(F.broadcast(hot), "__h", "left").withColumn(
            "__salt", F.pmod(F.xxhash64(F.col(member)), F.coalesce("__parts", F.lit(1))).cast("int")
        ).drop("__parts")
    else:
        rows = rows.withColumn("__salt", F.lit(0))
    ranged = rows.repartitionByRange("__h", "__salt") if hot_rows else rows.repartitionByRange("__h")
    run = Window.partitionBy("__h", "__salt", *group, "__key") if hot_rows else Window.partitionBy("__h", *group, "__key")
    scan = run.orderBy(member).rowsBetween(Window.unboundedPreceding, 0)
    labelled = ranged.withColumn("class_id", F.first(member).over(scan))
    if not hot_rows:
        return labelled.select(*group, member, *carry, "class_id")
    heads = labelled.where((F.col(member) == F.col("class_id"))).join(F.broadcast(hot), "__h").select(
        *group, "__h", "__key", F.col("class_id").alias("__run")
    ).distinct()
    merge = Window.partitionBy("__h", *group, "__key").orderBy("__run").rowsBetween(Window.unboundedPreceding, 0)
    merged = heads.withColumn("__class", F.first("__run").over(merge)).select("__h", *group, "__run", "__class")
    return (
        labelled.drop("__key").withColumnRenamed("class_id", "__run")
        .join(F.broadcast(merged), ["__h", *group, "__run"], "left")
        .select(*group, member, *carry, F.coalesce("__class", "__run").alias("class_id"))
    )


def pairs(members: DataFrame, group: list[str], member: str, differ: str | None = None, block: int = PAIR_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every pair id_a < id_b of different members of a class, by blocks.

    ``members`` has one row for each (group, class_id, member) and should be a written table, as it
    is read for the sizes and for both sides.  A class of n members is cut into ceil(n / block)
    blocks; each pair of blocks is a join key of its own, so that no task gets more than ``block``
    rows of a side, however large the class is.  With ``differ``, only pairs whose values of that
    column differ.

    Sizes come to the members by a join on the class, which gathers at most ``hot_rows`` members in
    a task: the sizes of larger classes, of which there are at most rows / ``hot_rows``, are broadcast.
    """
    keys = [*group, "class_id"]
    sizes = materialize(
        members.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").withColumn("__blocks", F.ceil(F.col("__n") / block).cast("int")), "sizes"
    )
    kept = members.join(sizes.where(F.col("__n") <= hot_rows).drop("__n"), keys)
    hot = sizes.where(F.col("__n") > hot_rows).drop("__n").collect()  # at most rows / hot_rows
    if hot:
        large = F.broadcast(members.sparkSession.createDataFrame(hot, sizes.drop("__n").schema))
        kept = members.join(large, keys, "left_anti").join(sizes.drop("__n"), keys).unionByName(members.join(large, keys))
    kept = kept.withColumn("__b", F.pmod(F.xxhash64(F.col(member)), F.col("__blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    extra = [differ] if differ else []
    left = kept.select(*group, "class_id", F.col(member).alias("id_a"), *[F.col(c).alias("__x") for c in extra], F.col("__b").alias("__i"), every.alias("__j")).where("__j >= __i")
    right = kept.select(*group, "class_id", F.col(member).alias("id_b"), *[F.col(c).alias("__y") for c in extra], F.col("__b").alias("__j"), every.alias("__i")).where("__j >= __i")
    joined = left.join(right, [*group, "class_id", "__i", "__j"]).where(
        F.col("id_a") != F.col("id_b")
    ).where((F.col("__i") != F.col("__j")) | (F.col("id_a") < F.col("id_b")))
    if differ:
        joined = joined.where(F.col("__x") != F.col("__y"))
    return joined.select(*group, F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
