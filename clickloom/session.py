"""Session set-up and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "clickloom", **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a session that names
    none (a local test) gets a folder of its own, which goes when the program ends. Elsewhere Spark's
    setting ``spark.cleaner.referenceTracking.cleanCheckpoints`` removes checkpoints no longer used.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="clickloom-checkpoint-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        sc.setCheckpointDir(shared)
    return df.checkpoint(eager=True)
