"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# AQE picks join strategies from measured sizes and splits skewed join partitions;
# the other settings only pin semantics (UTC, Arrow transfer).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "clickloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local session without that setting falls back to a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="clickloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one; it is deleted when the application ends."""
    folder = os.path.join(shared_dir(spark), f"clickloom-{spark.sparkContext.applicationId}")
    if folder not in _run_dirs:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _run_dirs.add(folder)
    return folder


_run_dirs: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the application's folder."""
    return os.path.join(run_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    The copy outlives lost executors, unlike a cached or locally checkpointed one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    copy = spark.read.schema(df.schema).parquet(path)
    _copies[copy] = path
    return copy


_copies: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*copies: DataFrame) -> None:
    """Deletes copies that ``materialise`` made; nothing that is still to run may read them."""
    for copy in copies:
        path = copy.sparkSession._jvm.org.apache.hadoop.fs.Path(_copies.pop(copy))
        path.getFileSystem(copy.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# files of a query's shuffles go when it ends, not when the driver collects its garbage
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]) -> Iterator[None]:
    """Settings that hold for what runs inside."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
