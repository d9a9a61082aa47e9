"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "gridstone", cores: str | int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the pipelines expect. ``cores`` selects local mode;
    without it the master comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Recording the call site of every column operation multiplies plan-building time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(os.cpu_count() if cores == "*" else cores))
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="gridstone-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise reliably in the shared folder, so a lost executor costs no recomputation."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written_once(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder as Parquet and read back: what follows may read them often,
    and only the columns it needs."""
    path = scratch_path(df.sparkSession, label)
    void = [f.name for f in df.schema.fields if f.dataType.typeName() == "void"]
    df.drop(*void).write.parquet(path)
    back = df.sparkSession.read.schema(df.drop(*void).schema).parquet(path)
    return back.select(*[F.lit(None).alias(c) if c in void else F.col(f"`{c}`") for c in df.columns])
