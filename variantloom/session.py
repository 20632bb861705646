"""Session defaults and reliable checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# HotSpot does not compile methods above 8000 bytes of bytecode; a longer fused
# stage would run interpreted, so Spark is told to split it instead.
JIT_METHOD_LIMIT = "8000"


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings every query of this library wants."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    return spark


def small_batches(spark: SparkSession) -> None:
    """Hand wide rows to Python by size: ten thousand of them would be one batch otherwise."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def build_session(master: str | None = None, app: str = "variantloom", **conf: str) -> SparkSession:
    """A session with adaptive execution; cluster settings are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def local_session(cpus: int | str = 8, app: str = "variantloom-local") -> SparkSession:
    """Single-machine session used by the tests and the benchmark."""
    spark = build_session(
        f"local[{cpus}]",
        app,
        **{
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("VARIANTLOOM_DRIVER_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; a scratch folder only when unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")


def stored_path(spark: SparkSession) -> str:
    """A new path in the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Parquet in the checkpoint folder, read back: for wide or long tables, whose readers want few columns."""
    spark = df.sparkSession
    path = stored_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
