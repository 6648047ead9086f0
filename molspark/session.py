"""The shared folder for checkpoints and working tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach.")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="molspark-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """Rows over all tasks, for heavy per-row work on a table of few files.

    A table with at least as many files as there are tasks is left as it is: it needs no shuffle.
    """
    tasks = shuffle_partitions(df.sparkSession)
    return df.repartition(tasks) if len(df.inputFiles()) < tasks else df


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a working table under the shared folder."""
    folder = f"{_shared_root(spark).rstrip('/')}/molspark-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(folder)
    return f"{folder}/{name}"


_scopes: list[list[str]] = []


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the working tables made inside when it ends. What is returned must be read before."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(table: DataFrame) -> None:
    """Delete a working table, as `materialised` gave it, that nothing will read again."""
    for folder in {file.rsplit("/", 2)[0] for file in table.inputFiles()}:
        _delete(table.sparkSession, folder)


# A query's shuffle files go when it ends, not when the driver's memory is next cleaned.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialised(df: DataFrame, outer: bool = False) -> DataFrame:
    """Write `df` once as a working table in the shared folder and read it back.

    This cuts the lineage, survives the loss of any executor, and unlike an RDD checkpoint computes
    the rows only once and keeps them columnar. With `outer` the table outlasts the innermost `work_scope`.
    """
    spark = df.sparkSession
    path = work_path(spark, "table")
    if outer and _scopes:
        folder = _scopes[-1].pop()
        if len(_scopes) > 1:
            _scopes[-2].append(folder)
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_END)
        else:
            spark.conf.set(SHUFFLES_END, before)
    return spark.read.schema(df.schema).parquet(path)
