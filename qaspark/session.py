"""Session settings and the shared scratch folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "qaspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # recording the Python call site of every column operation makes large plans slow to build
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches end by bytes, not by rows alone, as texts and lists differ in length by a factor of thousands."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's setting, never guessed on a cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; each call gives another one."""
    return f"{_shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are stored in the shared folder and the lineage is cut there."""
    folder = _shared_dir(df.sparkSession)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (columnar, so it prunes)."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
