"""Shared building blocks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.session import checkpoint_root


def latest_by(df: DataFrame, keys: Sequence[str], order_col: str,
              tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Newest row per key: `ROW_NUMBER() OVER (PARTITION BY keys ORDER BY
    order_col DESC, ...) = 1` written as an aggregate.

    `max(struct(order, rest...))` is a partial (map-side) aggregate, so a key
    holding a third of all rows is reduced inside every map task before the
    shuffle; a window would pull the whole group into one task.  Ties on
    `order_col` are broken by `tie_breakers`, then by the remaining columns
    in their frame order, all descending, NULL lowest.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [order_col] + [c for c in tie_breakers if c != order_col] + \
        [c for c in rest if c != order_col and c not in tie_breakers]
    return (df.groupBy(*keys)
            .agg(F.max(F.struct(*ordered)).alias("_latest"))
            .select(*keys, *[F.col("_latest").getField(c).alias(c) for c in rest]))


#: Fixed values of `newest_id`: a long spans 2**64; timestamps lie within 2**60 microseconds of 1970.
_LONG, _HALF_LONG, _TIMES = 2 ** 64, 2 ** 63, 2 ** 60


def newest_id(df: DataFrame, keys: Sequence[str], time_col: str, id_col: str) -> DataFrame:
    """`latest_by(df, keys, time_col, [id_col])` for a plan that needs no other
    column: time (timestamp without zone) and id (long) are one decimal, whose
    maximum has a buffer of fixed width. Spark then aggregates by hashing; the
    struct of `latest_by` makes it sort the rows of every map task first.

    NULL times are lowest, as there; ids must not be NULL. The session's time
    zone is UTC.
    """
    def whole(n: int) -> Column:
        return F.lit(Decimal(n))

    micros = F.coalesce(F.unix_micros(F.col(time_col).cast("timestamp")), F.lit(-_TIMES))
    packed = (micros.cast("decimal(20,0)") + whole(_TIMES)) * whole(_LONG) + (F.col(id_col).cast("decimal(20,0)") + whole(_HALF_LONG))
    top = df.groupBy(*keys).agg(F.max(packed.cast("decimal(38,0)")).alias("_top"))
    place = F.call_function("div", F.col("_top"), whole(_LONG)) - F.lit(_TIMES)
    time = F.when(place != -_TIMES, F.timestamp_micros(place)).cast("timestamp_ntz")
    low = (F.col("_top") % whole(_LONG) - whole(_HALF_LONG)).cast("long")
    return top.select(*keys, time.alias(time_col), low.alias(id_col))


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """`df` with its place (from 1) in a total order, without sorting in one task.

    Rows are range-partitioned by the order and written once (the partition
    bounds come from a sample); the rank is the place within the partition plus
    the rows of the partitions before, of which the driver gets one count each.
    """
    checkpoint_root(df.sparkSession)
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = {r["_part"]: r["count"] for r in parts.groupBy("_part").count().collect()}
    before = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0)))]
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    offset = F.element_at(F.array(*[F.lit(n) for n in before]), F.col("_part") + 1)
    return parts.withColumn(name, (inner + offset).cast("long")).drop("_part")
