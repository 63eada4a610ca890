"""Session settings for local runs (tests, bench). A cluster job brings its own session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A `local[cores]` session without the web page; AQE on, UTC, ANSI left at its default (on).

    Two settings are worth taking over on a cluster: adaptive execution may hash a small side instead of
    sorting both, and generated methods beyond what the JVM compiles (8000 bytes) are split instead.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gapwright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it; on a local master one of our own."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    if named is None:
        named = tempfile.mkdtemp(prefix="gapwright-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


#: Whether the shuffle files of a query go when it ends. A job that is planned anew for every run shares none.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs that write within this leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """The same rows read from a table in the shared folder, for a long lineage that is read more than once, or that
    shuffles more than should lie on the disks together: the shuffle files go when the table is written.

    The table stays there for the caller to remove, as the result may be read at any time.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Deletes a table of `stored` that nothing will read again."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("table-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
