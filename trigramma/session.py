"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The folder of the run that is going on, below the shared one.
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)

# Settings the plans rely on. Every one of them is also the Spark default,
# save the time zone; they are named here so that a session which switched
# one off is easy to spot.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str, cores: int | str = 8, **settings: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors see.

    Where it is unset, a local master, of which all executors are this process, gets a temporary
    folder, deleted when the process ends; on a cluster that would be wrong, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="trigramma-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the run, or of all runs, for a table written once."""
    folder = _run_folder.get() or shared_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as parquet to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if _run_folder.get():
        release(df.sparkSession)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def release(spark: SparkSession) -> None:
    """Let go of what finished steps left: shuffle files, broadcasts and plans.

    Spark drops them when the driver's JVM collects its garbage. A run of many small steps may go on for
    minutes without, while the heap grows to all it may have.
    """
    spark.sparkContext._jvm.System.gc()


def hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path in its terms."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def clear(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables that nothing reads any more."""
    files, there = hadoop(spark, path)
    files.delete(there, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialised`` wrote, once the last plan that reads them has run."""
    for table in tables:
        clear(table.sparkSession, table._written_to)


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Tables written inside the block go to a folder of their own, which the end of the block deletes.

    What the block makes must have been written elsewhere, or collected, by then: frames that read its
    tables are of no use afterwards. Blocks may stand in one another. The driver lets go of each step inside as it
    ends (``release``).
    """
    path = scratch_path(spark, name)
    before = _run_folder.set(path)
    try:
        yield path
    finally:
        _run_folder.reset(before)
        clear(spark, path)
        release(spark)
