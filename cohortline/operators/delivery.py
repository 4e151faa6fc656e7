"""What of an outbox was delivered: batch keys, a ledger of attempts, and the batches still to send.

The ledger is a log of ``batch_key, status, attempted_ts`` that ``append_run`` keeps; a client writes a row for every attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENT, FAILED = "sent", "failed"
LEDGER = "batch_key string, status string, attempted_ts timestamp_ntz"


def keyed_batches(batches: DataFrame) -> DataFrame:
    """``batches`` with a ``batch_key`` from their content alone, so it is the same however the rows were partitioned."""
    return batches.withColumn("batch_key", F.sha2(F.col("payload").cast("binary"), 256))


def attempts(ledger: DataFrame) -> DataFrame:
    """One row per batch: how often it was tried, whether it was ever delivered, and when it was tried last.

    Rows without a key tell nothing and are left out; a delivery counts however many failures stand beside it.
    """
    known = ledger.filter(F.col("batch_key").isNotNull())
    return known.groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.coalesce(F.max(F.col("status") == SENT), F.lit(False)).alias("delivered"),
        F.max("attempted_ts").alias("last_attempt_ts"),
    )


def undelivered(batches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Whole batches that no attempt delivered; those never tried count too."""
    sent = ledger.filter(F.col("status") == SENT).select("batch_key")
    return batches.join(sent, "batch_key", "left_anti").select(*batches.columns)


def due_again(batches: DataFrame, ledger: DataFrame, max_attempts: int) -> DataFrame:
    """Undelivered batches with their number of attempts and whether these are used up."""
    tried = attempts(ledger).select(F.col("batch_key").alias("_of"), "n_attempts", "delivered")
    known = batches.join(tried, F.col("batch_key") == F.col("_of"), "left").filter("delivered IS NULL OR NOT delivered")
    count = F.coalesce("n_attempts", F.lit(0))
    return known.select(*batches.columns, count.alias("n_attempts"), (count >= max_attempts).alias("given_up"))
