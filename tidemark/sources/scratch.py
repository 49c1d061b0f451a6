"""Written intermediate tables in the folder that all executors share.

Iterative operators cut their lineage by writing a table and reading it back. The folder is the one the
session names in ``spark.checkpoint.dir``, else the one set by ``SparkContext.setCheckpointDir``; a session on one machine without
either (tests) gets one of its own, and on a cluster that is an error. A written table survives the loss of any executor,
holds columns compressed, and gives the optimizer its true size.
"""

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_left: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, or a temporary one where the session names none and runs on one machine."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _own[app]


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of an address, and the address as its path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on the file system its address names."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


class Scratch:
    """Tables of one operator call. ``drop`` deletes superseded ones; those the result reads go with ``clear`` or when the process ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _left.append((spark, self.base))

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.base}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and return it as read back, with the same schema."""
        return self.stored(df, name, partition_by)[0]

    def stored(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
        """``table``, and the path it lies under."""
        path = self.path(name)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str) -> None:
        for path in paths:
            delete(self.spark, path)


def clear(spark: SparkSession) -> None:
    """Delete all tables of this session's operators. Results that were not written or collected before cannot be read any more."""
    for entry in [e for e in _left if e[0] is spark]:
        _left.remove(entry)
        delete(*entry)


@atexit.register
def _clear() -> None:
    for spark, base in _left:
        with contextlib.suppress(Exception):
            delete(spark, base)
