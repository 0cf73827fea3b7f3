"""Session settings, the checkpoint folder, and size checks used before a plan is chosen."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest table that is sent whole to every executor: rows, and rows times columns.
BROADCAST_ROWS = 500_000
BROADCAST_CELLS = 5_000_000
# Largest group of rows that one task may sort by itself.
GROUP_ROWS = 2_000_000


def build_session(app: str = "laurel", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the library relies on: UTC, adaptive execution, skew-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k: str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder the cluster names; a private one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="laurel-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession) -> str:
    """New path below the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/laurel-{uuid.uuid4().hex}"


def stored_copy(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives later plans column pruning and file sizes.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Broadcast hint when `df` is counted to be small.

    A larger table gets no hint: it is joined by shuffle, where adaptive execution splits hot keys.
    `counted` is a cheaper table with as many rows, counted instead.
    """
    rows = (df if counted is None else counted).count()
    small = rows <= max_rows and rows * len(df.columns) <= BROADCAST_CELLS
    return F.broadcast(df) if small else df


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a table whose size is bounded by construction; the caller states the bound."""
    return F.broadcast(df)
