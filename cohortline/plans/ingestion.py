"""The daily load of new admissions into the stored table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators import spells
from cohortline.operators.columns import missing_columns, split_on_required
from cohortline.operators.keys import first_per_key, upsert_insert_only
from cohortline.operators.outbox import BATCH_ROWS, outbox_batches
from cohortline.operators.reporting import counted_log_row
from cohortline.plans.admissions import OperationalTables, admissions_base, published
from cohortline.session import staged_observed
from cohortline.sources.schemas import ADMISSION_COLUMNS, ADMISSION_ID_COLUMNS
from cohortline.sources.state import BucketedState, Manifest
from cohortline.sources.writers import append_run


@dataclass(frozen=True)
class Load:
    """What one load writes: the new state, the rejected rows, the log row, the documents.

    ``rows`` and ``rejects`` were counted by the job that staged the rows.
    """

    loaded: DataFrame
    rejected: DataFrame
    incoming: DataFrame
    state: DataFrame
    log: DataFrame
    rows: int
    rejects: int

    def documents(self, size: int = BATCH_ROWS) -> DataFrame:
        """The loaded rows as bulk documents."""
        order = ["child_service_id", "child_financial_guardian_id"]
        return outbox_batches(self.loaded, order, size, ADMISSION_COLUMNS)


def ingest_admissions(
    tables: OperationalTables,
    store: DataFrame,
    as_of: dt.date,
    loaded_at: dt.datetime,
    pilot_centers: tuple[str, ...],
    lookback_days: int = spells.LOOKBACK_DAYS,
) -> Load:
    """Insert the new admissions that the store lacks; stored rows keep their values.

    Rows without a required id are set aside.  Of a child with several payers the store takes
    the lowest payer id.
    """
    base, seen = staged_observed(
        published(admissions_base(tables, as_of, lookback_days), pilot_centers).select(*ADMISSION_COLUMNS),
        "published",
        rows=F.count(F.lit(1)),
        rejects=F.count_if(missing_columns(ADMISSION_ID_COLUMNS) != ""),
    )
    loaded, rejected = split_on_required(base, ADMISSION_ID_COLUMNS)
    incoming = first_per_key(loaded, ["child_service_id"], ["child_financial_guardian_id"])
    return Load(
        loaded=loaded,
        rejected=rejected,
        incoming=incoming,
        state=upsert_insert_only(store, incoming, ["child_service_id"]),
        log=counted_log_row(base.sparkSession, seen["rows"] - seen["rejects"], loaded_at),
        rows=seen["rows"],
        rejects=seen["rejects"],
    )


def store_load(load: Load, state: BucketedState, log_path: str, run_id: str) -> Manifest:
    """Insert a load into a bucketed state and add its row to the log; the same run again changes neither.

    Only the buckets of the load's services are read, and only rows that the state lacks are written.
    """
    manifest = state.insert(load.incoming)
    append_run(load.log, log_path, run_id)
    return manifest
