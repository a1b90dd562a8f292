"""Session and table access shared by queries, tests and the bench."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str | int = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution; a cluster passes its own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of a batch that goes to Python, where the session has no number of its own: a worker holds a batch, its rows as Python's, and what it makes of them.
BATCH_ROWS = 512

_ROWS_A_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession | None = None) -> None:
    """Texts go to Python in small batches from now on (Spark's own are 10,000 rows), unless the session says how many."""
    spark = spark or SparkSession.active()
    if spark.conf.get(_ROWS_A_BATCH) == "10000":
        spark.conf.set(_ROWS_A_BATCH, str(BATCH_ROWS))


def data_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where the master is this one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="corpusloom-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, through the store's own file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(conf).delete(where, True)


_left: dict[str, SparkSession] = {}  # folders of tables that results may still read


def forget() -> None:
    """Remove the tables that this process has written for its results; it runs when the process ends."""
    for path, spark in list(_left.items()):
        with contextlib.suppress(Exception):  # the JVM may be gone already
            remove(spark, path)
        _left.pop(path, None)


atexit.register(forget)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared store for files of a result; it goes with forget()."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _left[path] = spark
    return path


_NO_SHUFFLES_LEFT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes made inside leave no shuffle files behind; else these stay until the driver happens to collect garbage."""
    before = spark.conf.get(_NO_SHUFFLES_LEFT)
    spark.conf.set(_NO_SHUFFLES_LEFT, "true")
    try:
        yield
    finally:
        spark.conf.set(_NO_SHUFFLES_LEFT, before)


class Scratch:
    """Written tables of one run in the shared folder.

    A table cuts the plan, so that nothing before it runs again and no lost executor
    undoes it. The run removes it when no later step reads it; what a result reads goes
    with forget(). A tidy one leaves no shuffle files of its tables.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False) -> None:
        self.spark, self.folder, self.made, self.tidy = spark, scratch_folder(spark, name), 0, tidy
        self.paths: dict[int, tuple[DataFrame, str]] = {}  # a table is held with its path, so that no other one gets its id

    def put(self, df: DataFrame) -> DataFrame:
        path, self.made = f"{self.folder}/{self.made}", self.made + 1
        with shuffles_removed(self.spark) if self.tidy else contextlib.nullcontext():
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def free(self, *tables: DataFrame) -> None:
        for t in tables:
            if held := self.paths.pop(id(t), None):
                remove(self.spark, held[1])

    def keep(self, *tables: DataFrame) -> None:
        """Free all but these."""
        self.free(*(t for t, _ in list(self.paths.values()) if not any(t is k for k in tables)))


def written(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder, read again: what comes before is not done twice, and no lost executor undoes it."""
    return Scratch(df.sparkSession, "table", tidy=True).put(df)
