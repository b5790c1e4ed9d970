"""Session defaults and the few driver-side helpers shared by operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Defaults for local runs; a cluster session keeps whatever it was built with.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vellumine")
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, so that workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_vellumine_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="vellumine-"), "vellumine.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(archive)
    context._vellumine_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    A temporary folder is made only where the setting is absent and the master is local, which
    is the case in tests; elsewhere executors wouldn't share it, so the setting is asked for.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context = spark.sparkContext
    if not hasattr(context, "_vellumine_scratch"):
        context._vellumine_scratch = tempfile.mkdtemp(prefix="vellumine-checkpoints-")
        atexit.register(shutil.rmtree, context._vellumine_scratch, ignore_errors=True)
    return context._vellumine_scratch


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and continue from the written copy.

    Used where a result feeds several later stages: the copy survives the loss of an executor
    and the work before it isn't repeated. Spark removes the copy when it is no longer
    referenced, if spark.cleaner.referenceTracking.cleanCheckpoints is set, as it is here for
    local sessions; else it stays until the owner of the folder clears it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Few rows that cost much, such as the input of a Python stage, over all tasks.

    Adaptive execution merges small partitions by their bytes, which tells nothing of the work.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 2))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
