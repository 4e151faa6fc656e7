"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

RUN = "cohortline.run"  # the session's setting that names its run

# A hot child, service or e-mail may own a large share of a table.  The operators combine
# before they shuffle; these settings let Spark split what is left of a hot join key, also
# where the split costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above; all of them can be set on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where a local master has none, as in tests, staged tables lie beside the warehouse's tables.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"


def run_dir(spark: SparkSession) -> str:
    """The folder of the present run: what is staged lies there until ``drop_run``."""
    run = spark.conf.get(RUN, None)
    if not run:
        run = uuid.uuid4().hex
        spark.conf.set(RUN, run)
    return f"{shared_dir(spark)}/cohortline/{run}"


def drop_run(spark: SparkSession) -> None:
    """Delete all that the present run has staged; DataFrames that read it end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    spark.conf.unset(RUN)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a parquet table in the run's folder and read it back.

    The lineage ends here, so a lost executor costs one file read and not the whole job, and
    the planner sees the true size: joins against a small staged table are broadcast, those
    against a large one are shuffled.
    """
    path = landing(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_observed(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``staged``, with aggregates that the writing job itself takes of the rows that it writes."""
    seen = Observation()
    kept = staged(df.observe(seen, *[m.alias(name) for name, m in metrics.items()]), label)
    return kept, seen.get


def landing(spark: SparkSession, label: str) -> str:
    """A new folder of the run."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
