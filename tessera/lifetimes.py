"""Who releases what a job keeps: persisted frames, scratch folders, catalog tables.

A query returns a lazy frame, so what that frame reads must outlive the call.
Inside ``scope(spark)`` everything kept on the way is noted and released when
the block ends, that is, when the consumer is done with the results::

    with scope(spark):
        queries()["s19_persist_reused_result"](spark, sf_dir).write.parquet(out)

Without a scope scratch folders are deleted when the application ends, and
persisted frames go with it.  Scopes nest; the innermost one notes.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


class _Open(list):
    """The scopes that are open, the innermost last.  They stay on the driver: with
    the package's code an empty list travels."""

    def __reduce__(self):
        return _Open, ()


_OPEN = _Open()


class Scope:
    """What one consumer's frames depend on."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.frames: list[DataFrame] = []
        self.folders: list[str] = []
        self.tables: list[str] = []
        self.before = set(_persistent(spark))

    def release(self) -> None:
        """Unpersist, drop and delete; what is gone already is no error.

        Some fits and summaries of the model library persist an RDD that only
        they know; what appeared since the scope began goes too.
        """
        while self.frames:
            self.frames.pop().unpersist(blocking=True)
        for key, rdd in _persistent(self.spark).items():
            if key not in self.before:
                rdd.unpersist(True)
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")
        while self.folders:
            path, files = _path(self.spark, self.folders.pop())
            files.delete(path, True)


def _persistent(spark: SparkSession) -> dict:
    """The session's persisted RDDs by number."""
    return dict(spark.sparkContext._jsc.getPersistentRDDs())


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Release at the end of the block, also after an error, what was kept inside it."""
    own = Scope(spark)
    _OPEN.append(own)
    try:
        yield own
    finally:
        _OPEN.remove(own)
        own.release()


def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """``df`` persisted until the scope ends."""
    df = df.persist(level)
    if _OPEN:
        _OPEN[-1].frames.append(df)
    return df


def note_folder(spark: SparkSession, folder: str) -> str:
    """A folder to be deleted with the scope, or else when the application ends."""
    if _OPEN:
        _OPEN[-1].folders.append(folder)
    path, files = _path(spark, folder)
    files.deleteOnExit(path)
    return folder


def note_table(name: str) -> str:
    """A catalog table to be dropped with the scope."""
    if _OPEN:
        _OPEN[-1].tables.append(name)
    return name
