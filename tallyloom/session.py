"""Session helpers: a tuned local session and the checkpoint folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "tallyloom") -> SparkSession:
    """Session for tests and benchmarks.  On a cluster, bring your own session:
    nothing in the library depends on these settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return the folder in use.

    The folder the cluster names in ``spark.checkpoint.dir`` wins.  A local session
    without that setting uses a folder under its warehouse path; on a cluster a
    folder must be named, because other executors have to read it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder: later plans start from there.

    Used before loops, whose every pass would otherwise plan the whole history
    again, and where two jobs must see the very same partitions.
    """
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def importable(df: DataFrame) -> None:
    """Let Python workers import this package also when the driver was started elsewhere.

    On a cluster ship the package with ``--py-files``; the folder added here then matches nothing.
    """
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
