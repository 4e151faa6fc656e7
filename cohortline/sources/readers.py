"""Readers: relational tables, CSV, JSON records, typed-attribute items."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.sources.json_arrays import read_json_array_files


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives.

    ``location`` is a path for file formats; for ``jdbc`` it is a table name or, with
    ``is_query=True``, a SELECT statement that the database runs.  A large relational table
    should name a numeric or date ``split_column`` with its bounds, so that ``splits`` tasks
    read it in parallel.
    """

    format: str
    location: str
    schema: str | None = None
    is_query: bool = False
    split_column: str | None = None
    split_bounds: tuple[str, str] | None = None
    splits: int = 1
    options: dict[str, str] = field(default_factory=dict)


def jdbc_options(spec: TableSpec) -> dict[str, str]:
    """Options of the JDBC source; a split read needs its query as a derived table."""
    options = {"fetchsize": "10000", **spec.options}
    if spec.split_column is None:
        return {**options, ("query" if spec.is_query else "dbtable"): spec.location}
    if spec.split_bounds is None:
        raise ValueError("a split column needs its lower and upper bound")
    return {
        **options,
        "dbtable": f"({spec.location}) source" if spec.is_query else spec.location,
        "partitionColumn": spec.split_column,
        "lowerBound": spec.split_bounds[0],
        "upperBound": spec.split_bounds[1],
        "numPartitions": str(spec.splits),
    }


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    if spec.format == "jdbc":
        options = jdbc_options(spec)
        if spec.schema:
            options["customSchema"] = spec.schema
        return spark.read.format("jdbc").options(**options).load()
    reader = spark.read.options(**spec.options)
    if spec.format == "csv":
        reader = reader.option("header", True)
    if spec.schema:
        reader = reader.schema(spec.schema)
    return reader.format(spec.format).load(spec.location)


def read_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``append_run`` wrote, each run once, with its ``run_id`` as text."""
    return spark.read.schema(f"{schema}, run_id string").parquet(path)


def read_records_json(
    spark: SparkSession, path: str, schema: str | T.StructType, array_files: bool = False
) -> DataFrame:
    """JSON records landed as files: one record per line, or with ``array_files`` one array per file.

    Both kinds of files are split across tasks.
    """
    if array_files:
        return read_json_array_files(spark, path, schema)
    return spark.read.schema(schema).json(path)


def flatten_typed_items(df: DataFrame, item: str, schema: str | T.StructType) -> DataFrame:
    """Items whose attributes carry a type tag, ``{"a": {"S": "x"}, "b": {"N": "1"}}``, as columns.

    Text that does not fit the wanted type gives NULL, as does a missing attribute.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    tagged = T.StructType([T.StructField(f.name, _TAGGED) for f in wanted.fields])
    items = df.select(F.from_json(F.col(item), tagged).alias("item"))
    return items.select(*[_attribute(F.col("item")[f.name], f) for f in wanted.fields])


_TAGGED = T.StructType().add("S", T.StringType()).add("N", T.StringType()).add("BOOL", T.BooleanType())


def _attribute(value: Column, wanted: T.StructField) -> Column:
    text = F.coalesce(value["S"], value["N"], value["BOOL"].cast("string"))
    return text.try_cast(wanted.dataType).alias(wanted.name)
