"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows, written as a table in the shared folder and read back.

    Cuts the lineage: what was computed survives the loss of any executor.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_draw(*parts: Column) -> Column:
    """A number in (0, 1) that the parts decide, the same in every engine that has MD5."""
    digest = F.md5(F.concat_ws("/", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def key_text(key: Column) -> Column:
    """The key as text; a null key is a text of its own."""
    return F.coalesce(key.cast("string"), F.lit("null"))


def safe_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of the `rows` keys with the smallest hashes; rows of one key count as one.

    Only keys meet at the driver, so what tasks send there does not grow with wide rows.
    """
    keys = [r[0] for r in df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(rows).collect()]
    return df.where(F.col(key).isin(keys))
