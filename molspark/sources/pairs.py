"""Input file pairs of many datasets as two tables.

Files of one kind differ in their columns, so they are read without a header by Spark's CSV parser,
wide enough for the widest of them, and each file's first row then names its cells. Line breaks and
quotes may stand in quoted cells. Blank cells and cells a short row lacks stay distinct: the former
are empty, the latter null.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.columns import SMILES, strip
from molspark.functions.ordering import sorted_position
from molspark.plans.discover import R_GROUPS_SUFFIX, SCAFFOLDS_SUFFIX
from molspark.session import materialised
from molspark.sources.listing import relative_key

# What a path must not have unescaped if it is to be read as it stands.
GLOB = re.compile(r"([\\\[\]{}*?])")


def _literal(path: str) -> str:
    return GLOB.sub(r"\\\1", path)


def _cell_count(record: Column) -> Column:
    """Cells of a record: commas outside quotes, and one."""
    outside = F.regexp_replace(record, '"(?:[^"]++|"")*+"', "")
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


def _parsed(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """``(path, line, cells, n)``: the first `width` cells of every record, and how many it has.

    A record that isn't `width` cells wide comes with its text, from which its cells are counted.
    """
    names = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in (*names, "_record"))
    rows = (
        spark.read.schema(schema)
        .option("header", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("maxCharsPerColumn", -1)
        .option("columnNameOfCorruptRecord", "_record")
        .csv([_literal(p) for p in paths])
    )
    return rows.select(
        F.col("_metadata.file_path").alias("path"),
        F.monotonically_increasing_id().alias("line"),
        F.array(*names).alias("cells"),
        F.when(F.col("_record").isNull(), F.lit(width)).otherwise(_cell_count(F.col("_record"))).alias("n"),
    )


def _lines(spark: SparkSession, base: str, paths: Sequence[str], suffix: str) -> DataFrame:
    """``(dataset_id, pos, header, cells)`` of every data row, `pos` following file order.

    Positions are worked out once and written, so no later shuffle can change them.
    """
    # A file's first record, its header, is the widest that matters.
    firsts = _parsed(spark, paths, 1).groupBy("path").agg(
        F.min_by("n", "line").alias("n"), F.max(F.length(F.col("cells")[0])).alias("longest")
    )
    # A scan can't be asked for records alone, so a cell takes part.
    width = firsts.agg(F.max("n"), F.max("longest")).head()[0] or 1
    raw = _parsed(spark, paths, width)
    full = F.transform(F.slice("cells", F.lit(1), F.least("n", F.lit(width))), lambda c: F.coalesce(c, F.lit("")))
    key = relative_key(F.col("path"), base)
    if_folder = F.regexp_replace(key, "/[^/]*$", "")
    key = F.when(key.endswith(suffix), key).otherwise(if_folder)
    placed = materialised(
        sorted_position(raw.select("path", "line", full.alias("cells")), ["path", "line"], "pos").select(
            F.substring(key, F.lit(1), F.length(key) - len(suffix)).alias("dataset_id"), "path", "pos", "cells"
        )
    )
    headers = placed.groupBy("path").agg(
        F.min("pos").alias("_header_pos"), F.min_by("cells", "pos").alias("header")
    )
    # Headers are a row per file; adaptive execution broadcasts them or splits an oversized file.
    return (
        placed.join(headers, "path")
        .where(F.col("pos") > F.col("_header_pos"))
        .select("dataset_id", "pos", "header", "cells")
    )


def read_pairs(spark: SparkSession, base: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``scaffolds(dataset_id, scaffold_id, smiles)`` and fragment cells
    ``(dataset_id, label, pos, smiles)`` of the given datasets.

    Only their files are opened. Their ids pass through the driver as part of the file listing,
    which any scan of these files holds there.
    """
    names = [row["dataset_id"] for row in ids.select("dataset_id").toLocalIterator()]
    root = base.rstrip("/")
    if not names:
        empty = spark.range(0)
        text, number = F.lit("").alias, F.col("id").alias
        return (
            empty.select(text("dataset_id"), number("scaffold_id"), text("smiles")),
            empty.select(text("dataset_id"), text("label"), number("pos"), text("smiles")),
        )
    scaffold_lines = _lines(spark, base, [f"{root}/{n}{SCAFFOLDS_SUFFIX}" for n in names], SCAFFOLDS_SUFFIX)
    at = F.array_position(F.transform("header", lambda h: F.lower(strip(h))), SMILES)
    cell = F.when(at > 0, F.get("cells", (at - 1).cast("int")))
    scaffolds = scaffold_lines.select(
        "dataset_id",
        F.col("pos").alias("scaffold_id"),
        strip(F.coalesce(cell, F.lit(""))).alias("smiles"),
    )
    r_group_lines = _lines(spark, base, [f"{root}/{n}{R_GROUPS_SUFFIX}" for n in names], R_GROUPS_SUFFIX)
    cells = (
        r_group_lines.select("dataset_id", "pos", F.posexplode("header").alias("_at", "label"), "cells")
        .select("dataset_id", "label", "pos", F.get("cells", F.col("_at")).alias("smiles"))
    )
    return scaffolds, cells
