"""Which files exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_keys(spark: SparkSession, base: str, glob: str | None = None) -> DataFrame:
    """``(key, path, length)`` of every file below `base`; `key` is relative to it.

    Only file metadata is selected, so no content is read. A scan leaves files without a byte out, so
    the names come from the listing that the scan holds anyway.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(base)
    names = spark.createDataFrame([(n,) for n in found.inputFiles()], "name string")
    named = names.select(relative_key(F.col("name"), base).alias("key"), "name")
    sized = found.select(relative_key(F.col("path"), base).alias("key"), "path", "length")
    return named.join(sized, "key", "left").select(
        "key", F.coalesce("path", "name").alias("path"), F.coalesce("length", F.lit(0)).cast("long").alias("length")
    )


def relative_key(path: Column, base: str) -> Column:
    """A file URI's part after `base`, decoded."""
    folder = "/" + base.split(":", 1)[-1].strip("/") + "/"
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.substring(plain, F.instr(plain, folder) + len(folder), F.length(plain))


def existing(wanted: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `wanted` whose ``key`` exists."""
    return wanted.join(keys.select("key"), "key", "left_semi")
