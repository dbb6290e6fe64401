"""Working tables in the shared folder of the cluster.

Intermediate results that several plans read are written as Parquet and read
back. That cuts the lineage, gives later joins true file sizes, and survives
the loss of executors.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


_TEMPORARY: dict[str, str] = {}

# Spark's switch, off by default: shuffle files go when the statement that wrote them ends. Else they
# stay until the driver forgets its plan, so those of all earlier tables add up.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Codec of the warehouse's stored tables.
CODEC = "zstd"
_WRITERS: Counter[SparkSession] = Counter()
_BEFORE: dict[SparkSession, str | None] = {}
_SWITCH = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements inside leave no shuffle files; the session's own setting is back when the last of several threads ends."""
    with _SWITCH:
        if not _WRITERS[spark]:
            _BEFORE[spark] = spark.conf.get(SHUFFLES_END, None)
            spark.conf.set(SHUFFLES_END, "true")
        _WRITERS[spark] += 1
    try:
        yield
    finally:
        with _SWITCH:
            _WRITERS[spark] -= 1
            if not _WRITERS[spark]:
                del _WRITERS[spark]
                before = _BEFORE.pop(spark)
                if before is None:
                    spark.conf.unset(SHUFFLES_END)
                else:
                    spark.conf.set(SHUFFLES_END, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only where that is unset and driver and executors are one process, as in
    tests, a temporary folder stands in, one per application.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(
            f"set spark.checkpoint.dir to a folder that all executors of {master} share"
        )
    application = spark.sparkContext.applicationId
    if application not in _TEMPORARY:
        _TEMPORARY[application] = tempfile.mkdtemp(prefix="haulmart-")
    return _TEMPORARY[application]


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any Hadoop file system; none if it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(path)]


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless one of that name exists; of several writers one succeeds."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    try:
        out = system.create(target, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


class Workspace:
    """A private folder for the working tables of one run."""

    def __init__(self, spark: SparkSession, root: str | None = None, codec: str | None = None):
        self.spark = spark
        self.codec = codec
        self.path = f"{root or shared_folder(spark)}/work-{uuid.uuid4().hex}"

    def new_path(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def store(self, df: DataFrame, name: str) -> str:
        return self.store_slices([df], name)

    def store_slices(self, slices: Sequence[DataFrame], name: str) -> str:
        """One table of several frames, one after the other: the shuffle files of one are on disk at a time."""
        path = self.new_path(name)
        for df in slices:
            with shuffles_removed(self.spark):
                df.write.mode("append").parquet(path, compression=self.codec)
        return path

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        # With the schema given, reading back starts no inference job.
        return self.spark.read.schema(df.schema).parquet(self.store(df, name))

    def materialize_slices(self, slices: Sequence[DataFrame], name: str) -> DataFrame:
        return self.spark.read.schema(slices[0].schema).parquet(self.store_slices(slices, name))

    def keep_only(self, paths: Collection[str]) -> None:
        """Remove every table of this workspace but those in ``paths``, after their last reader."""
        kept = {p.rpartition("/")[2] for p in paths}
        for name in children(self.spark, self.path):
            if name not in kept:
                remove(self.spark, f"{self.path}/{name}")
