"""Session defaults and the scratch area used to cut long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "cloakwork", cpus: int | str | None = None) -> SparkSession:
    """Local session for tests and benches; on a cluster pass in your own."""
    cpus = cpus or "*"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only when nothing is set
    (tests, laptops) a fresh local folder is made and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="cloakwork-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch area and return a frame that reads it back.

    The written table survives lost executors, has no lineage, and carries file
    sizes, so Spark broadcasts it in later joins only while it is really small.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by :func:`materialize` once nothing reads it any more."""
    spark = df.sparkSession
    marker = f"{scratch_root(spark)}/tables/".split("//")[-1].lstrip("/")
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if marker in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
