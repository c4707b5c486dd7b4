"""Session settings for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ionsift")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "16384")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _one_machine(master: str) -> bool:
    """Driver and tasks share a file system: ``local`` and ``local[...]``, but not ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a new one in local mode only."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not _one_machine(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="ionsift-"))
    return sc.getCheckpointDir()


_folders: list[str] = []


@contextlib.contextmanager
def run_folder(spark: SparkSession):
    """Intermediate tables of the block go to a folder of their own, which is removed at its end.

    Results must be written before the block ends: they read these tables.
    """
    _folders.append(f"{shared_folder(spark)}/run-{uuid.uuid4().hex}")
    try:
        yield _folders[-1]
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """``run_folder`` for part of a query; yields a ``settle`` whose tables outlast the block."""
    outside = _folders[-1] if _folders else shared_folder(spark)
    with run_folder(spark):
        yield lambda df: settle(df, outside)


def settle(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from there.

    Used where several later steps read the same table: it is computed once, plans stay short,
    and a lost executor costs no more than a re-read. Parquet keeps column pruning.
    """
    spark = df.sparkSession
    path = f"{folder or (_folders[-1] if _folders else shared_folder(spark))}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_and_watch(df: DataFrame, **watched: Column) -> tuple[DataFrame, dict]:
    """``settle``, with the row count ``rows`` and other aggregates taken while writing."""
    seen = Observation()
    table = settle(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in watched.items()]))
    return table, seen.get
