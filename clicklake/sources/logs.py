"""Reading and writing log and metric files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clicklake.schemas import EVENT_LOG

TIMESTAMP_FORMATS = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def read_log(
    spark: SparkSession, path: str | None, schema: T.StructType = EVENT_LOG, fmt: str = "csv"
) -> DataFrame:
    """Scan a CSV (columns by the names in its header, declared types) or Parquet log.

    Malformed values fail, and so do a CSV without one of the columns and CSV files whose
    headers differ in order. Columns that the schema does not have are left out.
    """
    if not path:
        raise ValueError("no data path given")
    if fmt == "csv":
        named = spark.read.option("header", True).csv(path).columns
        missing = [field.name for field in schema if field.name not in named]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        as_written = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in named])
        return (
            spark.read.schema(as_written)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", TIMESTAMP_FORMATS)
            .csv(path)
            .select(*[f"`{name}`" for name in schema.names])
        )
    if fmt in ("parquet", "json", "orc"):
        return spark.read.schema(schema).format(fmt).load(path)
    raise ValueError(f"unsupported log format {fmt!r}")


def write_log(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write a log or metric table as a folder of files."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMATS).csv(path)
    elif fmt in ("parquet", "json", "orc"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unsupported log format {fmt!r}")


def write_metrics(metrics: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    """Write each metric table to ``<folder>/<name>_metrics``; returns the paths."""
    paths = []
    for name, frame in metrics.items():
        path = f"{folder.rstrip('/')}/{name}_metrics"
        write_log(frame, path, fmt)
        paths.append(path)
    return paths
