"""Which datasets have both input files and no output yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File names.
SCAFFOLDS_SUFFIX = "_scaffolds.csv"
R_GROUPS_SUFFIX = "_r_groups.csv"
OUTPUT_PREFIX = "processed/"
DONE_NAME = "/clusters.csv"


def _without(key: Column, suffix: str) -> Column:
    return F.substring(key, F.lit(1), F.length(key) - len(suffix))


def dataset_status(keys: DataFrame) -> DataFrame:
    """``(dataset_id, has_scaffolds, has_r_groups, done)`` of every id some key speaks of. Ids may
    contain path segments.

    One grouping over the keys does it: a hot prefix or a repeated key only adds to a partial
    aggregate.
    """
    key = F.col("key")
    inner = F.substring(
        key, F.lit(len(OUTPUT_PREFIX) + 1), F.length(key) - len(OUTPUT_PREFIX) - len(DONE_NAME)
    )
    kind = (
        F.when(key.endswith(SCAFFOLDS_SUFFIX), F.struct(F.lit(0).alias("kind"), _without(key, SCAFFOLDS_SUFFIX).alias("id")))
        .when(key.endswith(R_GROUPS_SUFFIX), F.struct(F.lit(1).alias("kind"), _without(key, R_GROUPS_SUFFIX).alias("id")))
        .when(
            key.startswith(OUTPUT_PREFIX) & key.endswith(DONE_NAME),
            F.struct(F.lit(2).alias("kind"), inner.alias("id")),
        )
    )
    is_kind = lambda n: F.bool_or(F.col("k.kind") == n)
    return (
        keys.select(kind.alias("k"))
        .where("k IS NOT NULL")
        .groupBy(F.col("k.id").alias("dataset_id"))
        .agg(is_kind(0).alias("has_scaffolds"), is_kind(1).alias("has_r_groups"), is_kind(2).alias("done"))
    )


def match_pairs(keys: DataFrame) -> DataFrame:
    """Ids having both input files."""
    return dataset_status(keys).where("has_scaffolds AND has_r_groups").select("dataset_id")


def processed_ids(keys: DataFrame) -> DataFrame:
    """Ids whose output exists among the keys."""
    return dataset_status(keys).where("done").select("dataset_id")


def discover(
    candidates: DataFrame, processed: DataFrame, overwrite: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(to process, skipped)``. With `overwrite` nothing is skipped. Sort at the point of use."""
    ids = candidates.select("dataset_id").distinct()
    if overwrite:
        return ids, ids.where(F.lit(False))
    return (
        ids.join(processed, "dataset_id", "left_anti"),
        ids.join(processed, "dataset_id", "left_semi"),
    )


def candidate(spark: SparkSession, keys: DataFrame, dataset_id: str = "") -> DataFrame:
    """All paired ids, or just the one asked for, which then need not be paired."""
    wanted = dataset_id.strip()
    if wanted:
        return spark.range(1).select(F.lit(wanted).alias("dataset_id"))
    return match_pairs(keys)


def missing_inputs(ids: DataFrame, keys: DataFrame) -> DataFrame:
    """Required input keys that do not exist, as ``(dataset_id, key)``."""
    required = ids.select(
        "dataset_id",
        F.explode(
            F.array(
                F.concat("dataset_id", F.lit(SCAFFOLDS_SUFFIX)),
                F.concat("dataset_id", F.lit(R_GROUPS_SUFFIX)),
            )
        ).alias("key"),
    )
    return required.join(keys.select("key"), "key", "left_anti").select("dataset_id", "key")
