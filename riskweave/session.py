"""Spark session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "riskweave", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and single-machine runs. A cluster passes its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    This is ``spark.checkpoint.dir``. Only a local-mode session without that setting gets a
    temporary folder; a cluster without it is refused, since a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="riskweave-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages depend on the written rows alone, which survive a lost executor, and read only the
    columns they use. ``file_rows`` bounds the rows of a file, for large rows: a reader holds some thousands at once.
    """
    path = new_path(df.sparkSession, "stage")
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
