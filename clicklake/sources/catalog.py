"""Tables in the Spark catalog: create, fill, look up, and run SQL with parameters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklake.schemas import PRIMARY_KEYS, STAR_TABLES

# Plain SQL type names and their Spark types.
SQL_TYPES = {
    "TEXT": "STRING",
    "INTEGER": "BIGINT",
    "REAL": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "TIMESTAMP": "TIMESTAMP_NTZ",
    "DATE": "DATE",
}
SAVE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def execute(
    spark: SparkSession, query: str, params: Sequence[Any] | Mapping[str, Any] | None = None
) -> DataFrame:
    """Run SQL text with ``?`` or ``:name`` parameters; errors pass through."""
    if params is None:
        return spark.sql(query)
    return spark.sql(query, args=params if isinstance(params, Mapping) else list(params))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _name(table: str) -> str:
    return ".".join(_quoted(part) for part in table.split("."))


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def insert_dataframe(df: DataFrame, table: str, if_exists: str = "append") -> int:
    """Write a frame to a table and return its row count, counted while writing."""
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists must be one of {tuple(SAVE_MODES)}, not {if_exists!r}")
    spark = df.sparkSession
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if if_exists == "append" and spark.catalog.tableExists(table):
        columns = spark.table(table).columns
        counted.select(*map(_quoted, columns)).write.insertInto(table)
    else:
        counted.write.mode(SAVE_MODES[if_exists]).format("parquet").saveAsTable(table)
    return seen.get["rows"]


def insert_rows(spark: SparkSession, table: str, rows: Iterable[Sequence[Any]]) -> int:
    """Append literal rows, typed by the table."""
    frame = spark.createDataFrame(list(rows), schema=table_schema(spark, table))
    return insert_dataframe(frame, table)


def create_table(
    spark: SparkSession,
    table: str,
    columns: Mapping[str, str] | T.StructType,
    primary_key: str | None = None,
    location: str | None = None,
) -> None:
    """Create an empty table unless it exists. A key is recorded, not enforced.

    ``location`` names the folder of its files; else the warehouse holds them.
    """
    if isinstance(columns, T.StructType):
        types = {f.name: f.dataType.simpleString() for f in columns}
    else:
        types = {name: SQL_TYPES.get(kind.upper(), kind) for name, kind in columns.items()}
    if primary_key is not None and primary_key not in types:
        raise ValueError(f"primary key {primary_key!r} is not a column of {table!r}")
    body = ", ".join(f"{_quoted(name)} {kind}" for name, kind in types.items())
    extra = f" TBLPROPERTIES ('primary_key' = {_literal(primary_key)})" if primary_key else ""
    if location is not None:
        extra = f" LOCATION {_literal(location)}{extra}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(table)} ({body}) USING parquet{extra}")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row, and null keys."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) | F.col(key).isNull())
    )


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    if not table_exists(spark, table):
        raise ValueError(f"table {table!r} does not exist")
    return spark.table(table).schema


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Position, name and type of the columns of a table."""
    fields = table_schema(spark, table).fields
    return spark.createDataFrame(
        [(at, f.name, f.dataType.simpleString()) for at, f in enumerate(fields)],
        "position int, name string, type string",
    )


def create_default_tables(spark: SparkSession) -> None:
    """The five reporting tables, empty."""
    for name, layout in STAR_TABLES.items():
        create_table(spark, name, layout, PRIMARY_KEYS.get(name))


def initialize(spark: SparkSession, ddl: str | None = None) -> None:
    """Run DDL statements separated by a semicolon at the end of a line, or the default tables."""
    if ddl is None:
        create_default_tables(spark)
        return
    for statement in ddl.split(";\n"):
        if text := statement.strip().rstrip(";"):
            spark.sql(text)
