"""Fragment loading, validity, attachment points, enumeration and descriptors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.columns import melt
from molspark.functions.kernel import TEXT_DESCRIPTORS, text_kernel
from molspark.functions.rounding import round_exact
from molspark.operators import clustering, descriptors, factorised
from molspark.operators import enumerate as library
from workload import inputs
from workload.inputs import LABELS

KERNEL = text_kernel()
# Attempts per scaffold of `enumerate_capped`, whose feature the cap is.
CAP = 2_000


def load_r_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = library.load_r_groups(inputs.r_group_rows(spark, sf_dir), LABELS, KERNEL)
    return library.indexed_r_groups(loaded).select("dataset_id", "label", "idx", "smiles")


def validity_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = melt(inputs.r_group_rows(spark, sf_dir), ["pos"], LABELS)
    return texts.select("pos", "label", KERNEL.is_valid(F.col("smiles")).alias("valid"))


def document_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        KERNEL.is_valid(F.col("text")).alias("valid"),
        KERNEL.n_points(F.col("text")).alias("n_points"),
    )


def attachment_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.scaffolds(spark, sf_dir).select(
        "scaffold_id", KERNEL.n_points(F.col("smiles")).alias("n_points")
    )


def long_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.load_r_groups(inputs.r_group_rows(spark, sf_dir), LABELS, KERNEL)


def _attempts(spark: SparkSession, sf_dir: str, cap: int | None = None) -> DataFrame:
    return library.attempts(
        inputs.scaffolds(spark, sf_dir), long_groups(spark, sf_dir), KERNEL, cap
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorised.enumerate_library(
        inputs.scaffolds(spark, sf_dir), long_groups(spark, sf_dir), KERNEL
    )


def enumerate_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.wide_products(_attempts(spark, sf_dir, CAP), LABELS)


def arity_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = long_groups(spark, sf_dir).groupBy("dataset_id").agg(
        F.count_distinct("label").alias("n_labels")
    )
    matched = library.match_arity(inputs.scaffolds(spark, sf_dir), counts, KERNEL)
    return matched.select("dataset_id", "scaffold_id", "n_points", "n_labels", "usable")


def weld(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.scaffolds(spark, sf_dir).select("smiles").unionByName(
        melt(inputs.r_group_rows(spark, sf_dir), [], LABELS).select("smiles")
    )
    text = library.trimmed("smiles")
    counted = texts.groupBy(text.alias("smiles")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("smiles", "n", KERNEL.prepare(F.col("smiles"))["text"].alias("welded"))


def first_seen_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return library.wide_products(products(spark, sf_dir), LABELS)


def stage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = inputs.scaffolds(spark, sf_dir), long_groups(spark, sf_dir), KERNEL
    return factorised.attempt_counts(*parts).join(library.possible_counts(*parts), "dataset_id")


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorised.described_library(
        inputs.scaffolds(spark, sf_dir), long_groups(spark, sf_dir), KERNEL
    )


def product_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, means and deviations of every brand's products, of which none is made."""
    found = _moments(spark, sf_dir)
    return found.select("dataset_id", "n", *(round_exact(F.col(f"{k}_{c}"), 6).alias(f"{k}_{c}") for c in TEXT_DESCRIPTORS for k in ("mean", "std")))


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorised.product_moments(inputs.scaffolds(spark, sf_dir), long_groups(spark, sf_dir), KERNEL)


def product_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised products of whole brands; the statistics come from their parts."""
    scaled = clustering.standardise(described(spark, sf_dir), TEXT_DESCRIPTORS, moments=_moments(spark, sf_dir))
    values = [round_exact(F.col(c), 5).alias(c) for c in TEXT_DESCRIPTORS]
    return scaled.select("dataset_id", "scaffold_id", "ord", *values)


def product_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).drop("r_groups")


def descriptor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptors.descriptor_stats(inputs.scaffolds(spark, sf_dir), KERNEL)


def round4(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        round_exact(F.col("l_extendedprice") / F.col("l_quantity"), descriptors.DECIMALS).alias("unit_price"),
    )


QUERIES = {
    "load_r_groups": load_r_groups,
    "validity_flag": validity_flag,
    "document_validity": document_validity,
    "attachment_points": attachment_points,
    "enumerate_capped": enumerate_capped,
    "arity_match": arity_match,
    "weld": weld,
    "first_seen_distinct": first_seen_distinct,
    "stage_stats": stage_stats,
    "descriptors": product_descriptors,
    "product_moments": product_moments,
    "product_zscore": product_zscore,
    "descriptor_counts": descriptor_counts,
    "round4": round4,
}

_SCAFFOLDS = "WITH " + inputs.SCAFFOLDS_SQL

ORACLES = {
    "load_r_groups": "WITH " + inputs.R_GROUPS_SQL + """
SELECT dataset_id, 'R1' AS label, idx, R1 AS smiles FROM usable_rows
UNION ALL SELECT dataset_id, 'R2', idx, R2 FROM usable_rows""",
    "validity_flag": "WITH " + inputs.R_GROUP_ROWS_SQL + f"""
SELECT pos, 'R1' AS label, {inputs.valid_sql('R1')} AS valid FROM r_group_rows
UNION ALL SELECT pos, 'R2', {inputs.valid_sql('R2')} FROM r_group_rows""",
    "document_validity": f"""
SELECT doc_id, {inputs.valid_sql('text')} AS valid, {inputs.points_sql('text')}::INT AS n_points
FROM documents""",
    "attachment_points": _SCAFFOLDS + f"""
SELECT scaffold_id, {inputs.points_sql('smiles')}::INT AS n_points FROM scaffolds""",
    "enumerate_capped": inputs.attempts_sql(CAP) + " SELECT * FROM attempts",
    "arity_match": "WITH " + inputs.SCAFFOLDS_SQL + "," + inputs.R_GROUPS_SQL + f""",
counts AS (SELECT DISTINCT dataset_id, 2 AS n_labels FROM usable_rows)
SELECT dataset_id, scaffold_id, {inputs.points_sql('trim(smiles)')}::INT AS n_points,
  coalesce(n_labels, 0)::INT AS n_labels,
  {inputs.valid_sql('trim(smiles)')}
    AND {inputs.points_sql('trim(smiles)')} = coalesce(n_labels, 0) AS usable
FROM scaffolds LEFT JOIN counts USING (dataset_id) WHERE trim(smiles) <> ''""",
    "weld": "WITH " + inputs.SCAFFOLDS_SQL + "," + inputs.R_GROUP_ROWS_SQL + rf""",
texts AS (
  SELECT trim(coalesce(smiles, '')) AS smiles, count(*) AS n FROM (
    SELECT smiles FROM scaffolds UNION ALL SELECT R1 FROM r_group_rows
    UNION ALL SELECT R2 FROM r_group_rows) GROUP BY 1
)
SELECT smiles, n, CASE WHEN NOT regexp_matches(smiles, '%9[1-9]')
  AND NOT regexp_matches({inputs.weld_sql('smiles')}, '{inputs.UNWELDABLE_SQL}')
  THEN {inputs.weld_sql('smiles')} END AS welded FROM texts""",
    "first_seen_distinct": inputs.products_sql() + " SELECT * FROM products",
    "stage_stats": inputs.attempts_sql() + """
SELECT dataset_id, count(*) AS attempted, count(smiles) AS valid,
  count(*) - count(smiles) AS skipped, count(*) AS possible FROM attempts GROUP BY 1""",
    "descriptors": inputs.products_sql() + "," + inputs.descriptors_sql("products")
    + " SELECT * EXCLUDE (R1, R2) FROM described",
    "product_moments": inputs.products_sql() + "," + inputs.descriptors_sql("products")
    + " SELECT dataset_id, count(*) AS n, "
    + ", ".join(
        f"round(avg({c}), 6) AS mean_{c}, round(stddev_pop({c}), 6) AS std_{c}" for c in TEXT_DESCRIPTORS
    )
    + " FROM described GROUP BY 1",
    "product_zscore": inputs.products_sql() + "," + inputs.descriptors_sql("products")
    + " SELECT dataset_id, scaffold_id, ord, "
    + ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER d > 1e-14 * abs(avg({c}) OVER d) "
        f"THEN round(({c} - avg({c}) OVER d) / stddev_pop({c}) OVER d, 5) ELSE 0.0 END AS {c}"
        for c in TEXT_DESCRIPTORS
    )
    + " FROM described WINDOW d AS (PARTITION BY dataset_id)",
    "descriptor_counts": _SCAFFOLDS + f"""
SELECT dataset_id, count(*) AS input,
  count(*) FILTER ({inputs.valid_sql('trim(smiles)')}) AS calculated,
  count(*) FILTER (NOT {inputs.valid_sql('trim(smiles)')}) AS failed
FROM scaffolds GROUP BY 1""",
    "round4": """
SELECT l_orderkey, l_linenumber, format('{:.4f}', l_extendedprice / l_quantity)::DOUBLE AS unit_price
FROM lineitem""",
}
