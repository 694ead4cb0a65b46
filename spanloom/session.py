"""Session helpers: a tuned local session, and the one place that decides where checkpoints go."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "spanloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with adaptive execution, Arrow and UTC; on a cluster the caller brings its own."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=base).getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; only where that is unset (tests) make a local one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spanloom-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the reliable checkpoint folder and go on from there; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as a compressed table below the checkpoint folder: smaller than a checkpoint, with statistics, and without the constraints that a checkpoint carries on from round to round."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def releasing(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``step`` on a DataFrame, whose shuffle files go as soon as the query that wrote them ends.

    Else they stay until the driver collects its garbage, which a driver with little to do seldom does: a step of many short queries
    would hold the files of all of them, each a file a task at least. The session's setting is as it was when the step is over. Tables
    that ``cut`` or ``written`` made are files of their own and stay; what else two queries read is worked out again by the second.
    """

    @wraps(step)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        conf = df.sparkSession.conf
        before = conf.get(RELEASE, "false")
        conf.set(RELEASE, "true")
        try:
            return step(df, *args, **kwargs)
        finally:
            conf.set(RELEASE, before)

    return run


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, for sessions started elsewhere."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
