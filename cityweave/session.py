"""Session settings, the shared work folder, stored tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "cityweave", cores: str = "8", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.driver.memory": "16g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.shuffle.partitions": "8",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a cluster a
    missing setting is an error, because executors cannot see the driver's own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if root is None:
        root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cityweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A path not used before, under the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: survives lost executors, computed once."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *jobs: Callable) -> list:
    """What the jobs return, in their order; they run at the same time, so that one's last tasks and planning leave no cores idle."""
    checkpoint_root(spark)  # chosen before the jobs ask for it
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def all_materialised(tables: Sequence[tuple[DataFrame, str]]) -> list[DataFrame]:
    """Each frame as ``materialised`` stores it under its name, all at once."""
    return at_once(tables[0][0].sparkSession, *[lambda df=df, name=name: materialised(df, name) for df, name in tables])


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt by their values to at least a task per core: a file of few row groups would be worked on by as few tasks."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def by_content(df: DataFrame, rows_per_part: int = 50_000, large_part: int | None = None, enough: int = 16) -> DataFrame:
    """A stored table dealt out by its rows' values, in a fixed order, into parts whose number follows from the row count.

    What goes by partition, as the start of a clustering and the bags of a forest do, then depends on the
    rows alone, neither on the files nor on the number of cores. With ``large_part`` parts beyond ``enough`` hold so many rows.
    """
    rows = df.count()
    parts = max(1, -(-rows // rows_per_part))
    if large_part is not None:
        parts = max(min(parts, enough), -(-rows // large_part))
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    return df.repartition(parts, *columns).sortWithinPartitions(*columns)
