"""Session defaults and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "graphloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on. Cluster settings given by spark-submit win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM never compiles methods of more bytecode than this; smaller ones are fast
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a checkpoint folder set on the context is used. Only a local-mode session
    may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="graphloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_folder(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which outlives lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same for many rows of numbers: a compressed table under the shared folder, where a checkpoint takes 28 bytes for two longs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
