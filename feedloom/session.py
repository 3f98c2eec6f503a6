"""Session settings for one machine, and the shared folder of any session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Row groups of written tables. Long texts are held by the group: by the task that writes them, for each file it has open,
#: and by the one that reads them, as a batch of rows ends with its group. The bytes are those of packed texts, so
#: whole pages are limited by their number too.
ROW_GROUP = 16 << 20
GROUP_PAGES = 128
SMALL_GROUPS = {"parquet.block.size": str(ROW_GROUP)}
PAGE_GROUPS = {**SMALL_GROUPS, "parquet.block.row.count.limit": str(GROUP_PAGES)}

#: So many files a task may write to at once; with fewer than there are folders, Spark sorts all records first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def local_session(cores: str = "*") -> SparkSession:
    """A session for tests and measurements; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@contextmanager
def setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    """A setting of the session for as long as this lasts."""
    kept = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, kept)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the folder that all executors share.

    That is the one named in ``spark.checkpoint.dir``. Where none is named, a session on one
    machine gets a temporary one; a cluster has to name it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="feedloom-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/feedloom/{purpose}-{uuid.uuid4().hex}"


def staged(
    df: DataFrame, purpose: str, by: Sequence[str] = (), compression: str | None = None, groups: Mapping[str, str] = SMALL_GROUPS
) -> DataFrame:
    """Write a table to the shared folder, in folders of ``by``, and go on from there.

    For results that are costly and used more than once, as an extraction before a sort, whose
    sampling would run it again. The table also outlives the executors that made it. Whole pages go in ``PAGE_GROUPS``.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**groups).partitionBy(*by).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
