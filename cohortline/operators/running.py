"""Running aggregates over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.session import staged


def max_before(df: DataFrame, group: str, order: str, value: str, label: str = "running") -> DataFrame:
    """One row ``group, order, prior`` for each group and moment: the largest ``value`` at strictly earlier moments, NULL if there is none.

    Two levels.  The moments are dealt by ranges of group and moment, and a first running maximum stays inside a range, so a group
    with a third of all rows is spread over as many tasks as it fills ranges.  A second one over the ranges' own maxima, at most one
    row for each range and group, gives what a range begins with.  Rows with a NULL group or moment are earlier than nothing and are left out.
    """
    moments = df.filter(F.col(group).isNotNull() & F.col(order).isNotNull())
    moments = moments.groupBy(group, order).agg(F.max(value).alias("_value"))
    dealt = moments.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id())
    kept = staged(dealt, label)

    inside = Window.partitionBy("_range", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    own = kept.withColumn("_own", F.max("_value").over(inside))

    ends = kept.groupBy(group, "_range").agg(F.max("_value").alias("_end"))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.max("_end").over(earlier)).filter("_carried IS NOT NULL")
    # Only groups that go on from one range to the next have anything to carry: at most one for each range.
    carried = staged(carried.select(F.col(group).alias("_of"), F.col("_range").alias("_at"), "_carried"), label)
    found = own.join(carried, (F.col(group) == F.col("_of")) & (F.col("_range") == F.col("_at")), "left")
    return found.select(group, order, F.greatest("_own", "_carried").alias("prior"))
