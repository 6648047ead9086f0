"""Data-quality gates.

A gate is one aggregation that yields a row per dataset with its figures and ``passed``. Reports of
different gates share the shape ``(dataset_id, gate, passed, report)``, `report` being JSON, so a
failing dataset can be left out of later stages by a semi join while the others go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.functions.columns import melt, strip
from molspark.functions.kernel import Kernel
from molspark.functions.rounding import round_exact

# Gate thresholds.
MIN_VALID_RATIO = 0.8
MIN_PRODUCTS = 1
MAX_DOMINANT_RATIO = 0.9

KEY = "dataset_id"


class DataQualityError(RuntimeError):
    """A failed gate; carries the figures that made it fail."""

    def __init__(self, message: str, report: dict[str, Any]):
        super().__init__(message)
        self.report = report


def cell_is_valid(cell: Column, kernel: Kernel) -> Column:
    """Validity as the ratio gate counts it: blank text is an empty structure, hence valid; a null
    (a cell the row was too short for) is invalid."""
    text = strip(cell)
    return F.coalesce((text == "") | kernel.is_valid(text), F.lit(False))


def _for_datasets(gate: DataFrame, datasets: DataFrame | None) -> DataFrame:
    """Add the datasets that have no rows at all, with null figures."""
    return gate if datasets is None else datasets.select(KEY).distinct().join(gate, KEY, "left")


def validity_gate(
    df: DataFrame,
    valid: Column,
    min_ratio: float = MIN_VALID_RATIO,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """Share of valid rows. Fails on no rows, or when the unrounded ratio is below `min_ratio`."""
    counts = df.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(valid).alias("valid")
    )
    counts = _for_datasets(counts, datasets).fillna(0, ["total", "valid"])
    ratio = F.when(F.col("total") > 0, F.col("valid") / F.col("total")).otherwise(F.lit(0.0))
    return counts.select(
        KEY,
        "total",
        "valid",
        (F.col("total") - F.col("valid")).alias("invalid"),
        round_exact(ratio, 4).alias("valid_ratio"),
        ((F.col("total") > 0) & (ratio >= min_ratio)).alias("passed"),
    )


def cell_gate(
    wide: DataFrame,
    columns: Sequence[str],
    kernel: Kernel,
    min_ratio: float = MIN_VALID_RATIO,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """The validity gate over single cells of several columns, not over rows."""
    cells = melt(wide, [KEY], columns)
    return validity_gate(cells, cell_is_valid(F.col("smiles"), kernel), min_ratio, datasets)


def attachment_gate(
    scaffolds: DataFrame,
    label_counts: DataFrame,
    kernel: Kernel,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """Scaffolds whose attachment points equal the number of fragment columns; fails at none.

    `label_counts` is ``(dataset_id, n_labels)`` as given, before bad fragments are dropped.
    """
    smiles = strip(F.col("smiles"))
    per_arity = (
        scaffolds.withColumn(
            "n_points",
            F.when((smiles != "") & kernel.is_valid(smiles), kernel.n_points(smiles)),
        )
        # Few distinct arities per dataset: the join below sees counts, not scaffolds.
        .groupBy(KEY, "n_points")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_arity = _for_datasets(per_arity, datasets).fillna(0, ["n"])
    matching = F.coalesce(
        F.sum(F.when(F.col("n_points") == F.col("n_labels"), F.col("n"))), F.lit(0)
    )
    return (
        per_arity.join(label_counts, KEY, "left")
        .withColumn("n_labels", F.coalesce("n_labels", F.lit(0)))
        .groupBy(KEY)
        .agg(
            F.sum("n").alias("total_scaffolds"),
            F.max("n_labels").cast("long").alias("r_group_columns"),
            matching.alias("matching_scaffolds"),
        )
        .withColumn("passed", F.col("matching_scaffolds") > 0)
    )


def min_count_gate(
    df: DataFrame, minimum: int = MIN_PRODUCTS, datasets: DataFrame | None = None
) -> DataFrame:
    """At least `minimum` rows."""
    return count_gate(df.groupBy(KEY).agg(F.count(F.lit(1)).alias("molecule_count")), minimum, datasets)


def count_gate(
    counts: DataFrame, minimum: int = MIN_PRODUCTS, datasets: DataFrame | None = None
) -> DataFrame:
    """The same for counts that are known already."""
    return (
        _for_datasets(counts, datasets)
        .fillna(0, ["molecule_count"])
        .withColumn("minimum_required", F.lit(minimum).cast("long"))
        .withColumn("passed", F.col("molecule_count") >= F.col("minimum_required"))
    )


def cluster_sizes(df: DataFrame, cluster_column: str = "cluster") -> DataFrame:
    """Rows per cluster; rows of a frame without the column all count as cluster -1."""
    cluster = F.col(cluster_column) if cluster_column in df.columns else F.lit(-1)
    return df.groupBy(KEY, cluster.cast("int").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size")
    )


def balance_gate(
    sizes: DataFrame,
    max_dominant_ratio: float = MAX_DOMINANT_RATIO,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """Share of the largest cluster. Fails only above `max_dominant_ratio`; no rows count as 1."""
    totals = sizes.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.sum("size").alias("total_molecules"),
        F.max("size").alias("largest_cluster_size"),
    )
    figures = ["n_clusters", "total_molecules", "largest_cluster_size"]
    totals = _for_datasets(totals, datasets).fillna(0, figures)
    ratio = F.when(
        F.col("total_molecules") > 0, F.col("largest_cluster_size") / F.col("total_molecules")
    ).otherwise(F.lit(1.0))
    return totals.select(
        KEY,
        *figures,
        round_exact(ratio, 4).alias("largest_cluster_ratio"),
        (ratio <= max_dominant_ratio).alias("passed"),
    )


def as_report(gate: DataFrame, name: str) -> DataFrame:
    """A gate's figures as one JSON column, so that all gates fit one table."""
    figures = [c for c in gate.columns if c not in (KEY, "passed")]
    return gate.select(
        KEY,
        F.lit(name).alias("gate"),
        F.coalesce("passed", F.lit(False)).alias("passed"),
        F.to_json(F.struct(*figures)).alias("report"),
    )


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def first_failures(reports: DataFrame, gate_order: Sequence[str]) -> DataFrame:
    """The first gate, in running order, that each failing dataset did not pass."""
    rank = F.array_position(F.array(*(F.lit(g) for g in gate_order)), F.col("gate"))
    failed = reports.where(~F.col("passed")).withColumn("_rank", rank)
    return failed.groupBy(KEY).agg(
        F.min_by("gate", "_rank").alias("gate"), F.min_by("report", "_rank").alias("report")
    )


def passing(datasets: DataFrame, reports: DataFrame) -> DataFrame:
    """Datasets with no failed gate."""
    return datasets.join(reports.where(~F.col("passed")), KEY, "left_anti")


def input_gate(
    scaffolds: DataFrame,
    cells: DataFrame,
    label_counts: DataFrame,
    kernel: Kernel,
    min_ratio: float = MIN_VALID_RATIO,
    datasets: DataFrame | None = None,
) -> DataFrame:
    """All input checks as reports: scaffold validity, fragment-cell validity, attachment points.

    `cells` is the long fragment table as read, ``(dataset_id, label, pos, smiles)``.
    """
    scaffold_text = scaffolds.withColumn("smiles", F.coalesce("smiles", F.lit("")))
    return union_reports(
        [
            as_report(
                validity_gate(
                    scaffold_text, cell_is_valid(F.col("smiles"), kernel), min_ratio, datasets
                ),
                "scaffold_validity",
            ),
            as_report(
                validity_gate(cells, cell_is_valid(F.col("smiles"), kernel), min_ratio, datasets),
                "r_group_validity",
            ),
            as_report(
                attachment_gate(scaffold_text, label_counts, kernel, datasets), "attachment_points"
            ),
        ]
    )


def raise_on_failure(reports: DataFrame) -> None:
    """Raise for the first failed report, for callers who want one dataset to stop the program."""
    failed = reports.where(~F.col("passed")).orderBy(KEY, "gate").head(1)
    if failed:
        row = failed[0]
        raise DataQualityError(
            f"Gate {row['gate']} failed for {row[KEY]}: {row['report']}", row.asDict()
        )


def run_datasets(discovered: DataFrame, passed: DataFrame, run_id: str) -> DataFrame:
    """The run's datasets, one row each, with whether they passed every gate."""
    return discovered.select(KEY).distinct().join(
        passed.select(KEY).distinct().withColumn("_passed", F.lit(True)), KEY, "left"
    ).select(F.lit(run_id).alias("run_id"), KEY, F.col("_passed").isNotNull().alias("passed"))


def run_summary(datasets: DataFrame, pipeline_id: str, run_id: str) -> DataFrame:
    """One row for the run, from `run_datasets`: counts and a headline.

    The ids stay rows of that table: a list of them all would be gathered in one task.
    """
    headline = F.when(F.col("discovered") == 0, F.lit("There was nothing new to run.")).otherwise(
        F.format_string("%d dataset(s) run, %d through every gate", "discovered", "passed")
    )
    return (
        datasets.agg(
            F.count(F.lit(1)).alias("discovered"), F.count_if("passed").alias("passed")
        )
        .withColumns(
            {"pipeline_id": F.lit(pipeline_id), "run_id": F.lit(run_id), "headline": headline}
        )
        .select("pipeline_id", "run_id", "discovered", "passed", "headline")
    )


def failure_records(
    failures: DataFrame, pipeline_id: str, run_id: str, log_base: str | None = None
) -> DataFrame:
    """A message per failed dataset, from ``(dataset_id, gate, report)``. With `log_base` each record
    links to ``log_base/run_id/stage/dataset_id``."""
    link = (
        F.concat_ws("/", F.lit(log_base.rstrip("/")), F.lit(run_id), "gate", KEY)
        if log_base
        else F.lit(None).cast("string")
    )
    records = failures.select(
        KEY, F.col("gate").alias("stage"), F.lit(run_id).alias("run_id"), F.col("report").alias("error"), link.alias("log_url")
    )
    lines = [
        F.concat(F.lit(f"{pipeline_id}, run {run_id}: dataset "), KEY, F.lit(" stopped at "), "stage"),
        F.concat(F.lit("Figures: "), "error"),
        F.concat(F.lit("Log: "), "log_url"),
    ]
    return records.withColumn("message", F.concat_ws("\n", *lines))
