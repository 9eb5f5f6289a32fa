"""Where written tables and checkpoints go."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from clickloom.options import JobOptions

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir``.

    A local session without it uses a folder of its warehouse. On a cluster there
    is nothing that executors are known to share, so the setting must be there.
    """
    configured = spark.conf.get(SHARED_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder that driver and executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/clickloom-scratch"


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` written to the shared folder, so that what made it runs once."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{shared_dir(frame.sparkSession)}/checkpoints")
    return frame.checkpoint()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark)}/clickloom/{name}-{uuid.uuid4().hex}"


def with_locations(spark: SparkSession, options: JobOptions) -> JobOptions:
    """Fill in the table and checkpoint folders the options leave open."""
    base = f"{shared_dir(spark)}/clickstream" if not (
        options.table_base and options.checkpoint_base
    ) else ""
    return replace(
        options,
        table_base=options.table_base or f"{base}/tables",
        checkpoint_base=options.checkpoint_base or f"{base}/checkpoints",
    )
