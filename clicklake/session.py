"""Session for tests and local runs; a cluster brings its own."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_own_folder: dict[str, str] = {}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clicklake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Do not record the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster shares, as spark.checkpoint.dir names it.

    Where it is unset, only a session whose executors all run in this process may go on,
    in a folder of this machine; on a cluster a local folder would lose rows unseen.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that driver and executors share")
        base = _own_folder.setdefault(context.applicationId, tempfile.mkdtemp(prefix="clicklake-"))
    return base.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder the cluster shares."""
    return f"{shared_base(spark)}/clicklake-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """The rows, written to a new path in the shared folder and read back."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
