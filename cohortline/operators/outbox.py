"""Outbox tables: rows as JSON documents for a client that posts them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.session import staged

# Fixed value.
BATCH_ROWS = 300

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def outbox_items(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One ``{"item": {...}}`` document per row; NULL stays a JSON null."""
    item = F.struct(*(columns or df.columns)).alias("item")
    return df.select(_json(F.struct(item)).alias("payload"))


def numbered_rows(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Rows with a gapless ``row_index`` from 0 in key order, without one global sort task.

    The rows are range-partitioned and staged, so their partition and position no longer move;
    the partition sizes, one number each, give the offset of every partition.  ``order_by``
    must identify a row.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    place = F.monotonically_increasing_id()
    placed = staged(
        ordered.withColumn("_place", place).select(
            "*",
            F.shiftright("_place", _POSITION_BITS).cast("int").alias("_part"),
            F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        ),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the exchange: the broadcast cannot grow with the data.
    located = placed.join(F.broadcast(offsets), "_part")
    return located.select(*df.columns, (F.col("_offset") + F.col("_position")).alias("row_index"))


def outbox_batches(
    df: DataFrame,
    order_by: Sequence[str],
    size: int = BATCH_ROWS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``{"items": [...]}`` documents of ``size`` rows each, in key order.

    A batch lies in one or two neighbouring partitions, so most of its rows meet before the
    exchange, and no group ever holds more than ``size`` rows.
    """
    columns = list(columns or df.columns)
    item = F.struct(*columns).alias("item")
    needed = df.select(*dict.fromkeys([*order_by, *columns]))
    rows = numbered_rows(needed, order_by).select(
        F.expr(f"row_index div {int(size)}").alias("batch_id"), "row_index", item
    )
    batches = rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sort_array(F.collect_list(F.struct("row_index", "item"))).alias("numbered"),
    )
    items = F.transform("numbered", lambda row: row["item"]).alias("items")
    return batches.select("batch_id", "n_items", _json(F.struct(items)).alias("payload"))
