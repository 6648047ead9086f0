"""CSV scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.functions.columns import union_by_name


def read_strings(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV with a header row, every cell a string, columns found by their header name.

    A column that the header lacks is null. Files of one path must share one header, else the scan
    raises. Blank lines are skipped; blank cells and cells a short row lacks are null. `multi_line`
    allows line breaks inside quotes, at the price of unsplit files.
    """
    header = _csv(spark, multi_line).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = _csv(spark, multi_line).option("enforceSchema", False).schema(schema).csv(path)
    return rows.select(
        *(F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns)
    )


def read_typed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with column types: the given ones, or inferred by one more pass over the files."""
    reader = _csv(spark, multi_line)
    return reader.schema(schema).csv(path) if schema else reader.csv(path, inferSchema=True)


def _csv(spark: SparkSession, multi_line: bool):
    # Quotes are doubled inside quoted cells, as the sink below writes them.
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def write_csv(frames: DataFrame | Sequence[DataFrame], path: str) -> str:
    """Write rows under the union of their columns, first seen first; missing cells are blank.

    An existing output is replaced. No rows still leave a header, so the result can be read back.
    """
    rows = frames if isinstance(frames, DataFrame) else union_by_name(frames)
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


RUN = "run"


def write_stage(df: DataFrame, path: str, run: str, key: str = "dataset_id") -> str:
    """Write what a run made of a stage as Parquet, one folder per dataset inside the run's own folder.

    Nothing of other runs is touched. The rebalance hint groups rows by dataset before the write and
    splits a dataset too large for one file, so neither many tiny files nor one huge task results.
    """
    folder = f"{path}/{RUN}={run}"
    df.hint("rebalance", key).write.partitionBy(key).parquet(folder)
    return folder


def read_current(spark: SparkSession, path: str, schema: T.StructType, pointers: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Each dataset's rows from the run that `pointers` (key, run) names for it.

    Both are folders, so Spark reads only the folders that the pointers lead to.
    """
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(whole).parquet(path)
    return rows.join(pointers.select(key, RUN), [key, RUN], "left_semi").drop(RUN)


def remove_runs(spark: SparkSession, paths: Iterable[str], kept: Iterable[str]) -> list[str]:
    """Delete the folders of all runs but those `kept`, and return which."""
    jvm, kept, gone = spark._jvm, set(kept), []
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.listStatus(folder) if files.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith(f"{RUN}=") and name.removeprefix(f"{RUN}=") not in kept:
                files.delete(status.getPath(), True)
                gone.append(f"{path}/{name}")
    return gone
