"""As-of join as a sorted merge.

Rows of both sides stand in one order (key, time); walking along it, the last
row of the right side is carried to the rows of the left side. The order is cut
into range partitions, so a key with any share of the rows is spread over many
tasks; what a partition carries on to the next ones is one row for each key and
partition. No row is ever paired with more than one other, so intermediate rows
number at most those of both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.session import written


def newest_before(times: DataFrame, rows: DataFrame, key: str, time: str, row_time: str) -> DataFrame:
    """`times` (key, time; distinct) with `_row`: of `rows` (the same key, row_time and more) the one that is newest at or before `time`.

    Of rows with one time the greatest wins, column by column. Rows and times
    with a null key or time meet nothing; a time without such a row is left
    out. The merged order is written to the checkpoint folder, as the carried
    rows must see the partitions that the walk saw.
    """
    value = [row_time, *[c for c in rows.columns if c not in (key, row_time)]]
    right = rows.filter(F.col(key).isNotNull() & F.col(row_time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(row_time).alias("_time"), F.lit(0).alias("_left"), F.struct(*value).alias("_row"))
    left = times.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.lit(1).alias("_left"), F.lit(None).cast(right.schema["_row"].dataType).alias("_row"))
    order = ["_key", "_time", "_left", "_row"]
    merged = written(right.unionByName(left).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "as-of")
    walk = Window.partitionBy("_part", "_key").orderBy("_time", "_left", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = merged.withColumn("_row", F.last("_row", ignorenulls=True).over(walk)).filter("_left = 1").drop("_left")
    here = seen.filter(F.col("_row").isNotNull()).drop("_part")
    # what earlier partitions carry on: a key has at most one row for each partition on either side
    ends = merged.filter("_left = 0").groupBy("_key", "_part").agg(F.max("_row").alias("_end"))
    waiting = seen.filter(F.col("_row").isNull()).drop("_row")
    asked = waiting.select("_key", "_part").distinct().withColumn("_end", F.lit(None).cast(right.schema["_row"].dataType))
    # a partition that asks has no right row before its first left row: its own end lies behind and does not count
    both = ends.withColumn("_asks", F.lit(1)).unionByName(asked.withColumn("_asks", F.lit(0)))
    carried = (both.withColumn("_row", F.last("_end", ignorenulls=True).over(
        Window.partitionBy("_key").orderBy("_part", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .filter("_asks = 0 AND _row IS NOT NULL").select("_key", "_part", "_row"))
    there = waiting.join(carried, ["_key", "_part"]).select("_key", "_time", "_row")
    return here.select("_key", "_time", "_row").unionByName(there).select(
        F.col("_key").alias(key), F.col("_time").alias(time), "_row")
