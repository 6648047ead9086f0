"""Data-quality gates, reports, summaries and failure records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions.kernel import text_kernel
from molspark.operators import factorised, gates
from workload import enumeration, inputs
from workload.inputs import LABELS, table

KERNEL = text_kernel()


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset that could exist, from the nations; some have no rows at small scales."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Brand#"), F.col("n_nationkey") + 1).alias("dataset_id")
    )


def validity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaffolds = inputs.scaffolds(spark, sf_dir)
    return gates.validity_gate(
        scaffolds, gates.cell_is_valid(F.col("smiles"), KERNEL), datasets=_brands(spark, sf_dir)
    )


def document_validity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("dataset_id"), "text")
    return gates.validity_gate(docs, gates.cell_is_valid(F.col("text"), KERNEL), min_ratio=0.01)


def cell_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.cell_gate(inputs.r_group_rows(spark, sf_dir), LABELS, KERNEL)


def _label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        inputs.r_group_rows(spark, sf_dir)
        .groupBy("dataset_id")
        .agg(F.max(F.lit(len(LABELS))).alias("n_labels"))
    )


def attachment_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.attachment_gate(
        inputs.scaffolds(spark, sf_dir),
        _label_counts(spark, sf_dir),
        KERNEL,
        _brands(spark, sf_dir),
    )


def min_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = factorised.product_counts(inputs.scaffolds(spark, sf_dir), enumeration.long_groups(spark, sf_dir), KERNEL)
    return gates.count_gate(counts, minimum=1500, datasets=_brands(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities as datasets; the cheaper orders of each form one large cluster."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("dataset_id"),
        F.when(F.col("o_totalprice") < 480000, 0).otherwise(F.col("o_orderkey") % 3 + 1).alias("cluster"),
    )


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.cluster_sizes(_labelled(spark, sf_dir))


def unlabelled_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.cluster_sizes(_labelled(spark, sf_dir).drop("cluster"))


def balance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.balance_gate(gates.cluster_sizes(_labelled(spark, sf_dir)), max_dominant_ratio=0.96)


def embedding_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.lit("embeddings").alias("dataset_id"), F.col("label").alias("cluster")
    )
    return gates.balance_gate(gates.cluster_sizes(rows))


def _input_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.r_group_rows(spark, sf_dir)
    cells = gates.melt(rows, ["dataset_id", "pos"], LABELS)
    return gates.input_gate(
        inputs.scaffolds(spark, sf_dir),
        cells,
        _label_counts(spark, sf_dir),
        KERNEL,
        datasets=_brands(spark, sf_dir),
    )


def input_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input_reports(spark, sf_dir).select("dataset_id", "gate", "passed")


def gate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _input_reports(spark, sf_dir)


GATE_ORDER = ["scaffold_validity", "r_group_validity", "attachment_points"]


def first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = gates.first_failures(_input_reports(spark, sf_dir), GATE_ORDER)
    return failed.select("dataset_id", "gate")


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = gates.first_failures(_input_reports(spark, sf_dir), GATE_ORDER)
    return gates.failure_records(failed, "library", "run-1", "https://logs.example/runs/")


def run_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _brands(spark, sf_dir)
    passed = gates.passing(ids, _input_reports(spark, sf_dir))
    return gates.run_datasets(ids, passed, "run-1")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.run_summary(run_datasets(spark, sf_dir), "library", "run-1")


QUERIES = {
    "validity_ratio": validity_ratio,
    "document_validity_ratio": document_validity_ratio,
    "cell_ratio": cell_ratio,
    "attachment_gate": attachment_gate,
    "min_count_gate": min_count_gate,
    "cluster_sizes": cluster_sizes,
    "unlabelled_sizes": unlabelled_sizes,
    "balance_gate": balance_gate,
    "embedding_balance": embedding_balance,
    "input_gate": input_gate,
    "gate_reports": gate_reports,
    "first_failure": first_failure,
    "failures": failures,
    "run_datasets": run_datasets,
    "run_summary": run_summary,
}

_BRANDS = "brands AS (SELECT 'Brand#' || (n_nationkey + 1) AS dataset_id FROM nation)"


def _cell_valid(text: str) -> str:
    return f"({text} IS NOT NULL AND (trim({text}) = '' OR {inputs.valid_sql(f'trim({text})')}))"


def _ratio(source: str, min_ratio: float, datasets: str | None) -> str:
    """Validity figures from a relation (dataset_id, ok)."""
    rows = f"{datasets} LEFT JOIN {source} USING (dataset_id)" if datasets else source
    return f"""
SELECT dataset_id, total, valid, total - valid AS invalid,
  CASE WHEN total > 0 THEN format('{{:.4f}}', valid / total)::DOUBLE ELSE 0.0 END AS valid_ratio,
  total > 0 AND valid / total >= {min_ratio}::DOUBLE AS passed
FROM (SELECT dataset_id, count(ok) AS total, count(*) FILTER (ok) AS valid FROM {rows} GROUP BY 1)"""


_SCAFFOLD_OK = f"scaffold_ok AS (SELECT dataset_id, {_cell_valid('smiles')} AS ok FROM scaffolds)"
_CELL_OK = f"""cell_ok AS (
  SELECT dataset_id, {_cell_valid('R1')} AS ok FROM r_group_rows
  UNION ALL SELECT dataset_id, {_cell_valid('R2')} FROM r_group_rows)"""
_ATTACHMENT = f"""
SELECT dataset_id, count(scaffold_id) AS total_scaffolds, coalesce(max(n_labels), 0)::BIGINT AS r_group_columns,
  count(*) FILTER (points = coalesce(n_labels, 0)) AS matching_scaffolds,
  count(*) FILTER (points = coalesce(n_labels, 0)) > 0 AS passed
FROM brands LEFT JOIN (
  SELECT *, CASE WHEN {inputs.valid_sql('trim(smiles)')} THEN {inputs.points_sql('trim(smiles)')} END AS points
  FROM scaffolds) USING (dataset_id)
LEFT JOIN (SELECT DISTINCT dataset_id, 2 AS n_labels FROM r_group_rows) USING (dataset_id)
GROUP BY 1"""
_RATIO_JSON = """'{"total":' || total || ',"valid":' || valid || ',"invalid":' || invalid
    || ',"valid_ratio":' || valid_ratio || '}'"""
_INPUT = f"""WITH {inputs.SCAFFOLDS_SQL}, {inputs.R_GROUP_ROWS_SQL}, {_BRANDS}, {_SCAFFOLD_OK}, {_CELL_OK},
reports AS (
  SELECT dataset_id, 1 AS step, 'scaffold_validity' AS gate, passed, {_RATIO_JSON} AS report
  FROM ({_ratio('scaffold_ok', 0.8, 'brands')})
  UNION ALL
  SELECT dataset_id, 2, 'r_group_validity', passed, {_RATIO_JSON} FROM ({_ratio('cell_ok', 0.8, 'brands')})
  UNION ALL
  SELECT dataset_id, 3, 'attachment_points', passed, '{{"total_scaffolds":' || total_scaffolds || ',"r_group_columns":'
    || r_group_columns || ',"matching_scaffolds":' || matching_scaffolds || '}}' FROM ({_ATTACHMENT})
)"""
_LABELLED = """labelled AS (
  SELECT o_orderpriority AS dataset_id,
    (CASE WHEN o_totalprice < 480000 THEN 0 ELSE o_orderkey % 3 + 1 END)::INT AS cluster FROM orders)"""


def _balance(source: str, limit: float) -> str:
    return f"""
SELECT dataset_id, count(*) AS n_clusters, sum(size)::BIGINT AS total_molecules,
  max(size) AS largest_cluster_size,
  format('{{:.4f}}', max(size) / sum(size))::DOUBLE AS largest_cluster_ratio,
  max(size) / sum(size) <= {limit}::DOUBLE AS passed
FROM (SELECT dataset_id, cluster, count(*) AS size FROM {source} GROUP BY ALL) GROUP BY 1"""


ORACLES = {
    "validity_ratio": f"WITH {inputs.SCAFFOLDS_SQL}, {_BRANDS}, {_SCAFFOLD_OK}"
    + _ratio("scaffold_ok", 0.8, "brands"),
    "document_validity_ratio": f"""
WITH doc_ok AS (SELECT source AS dataset_id, {_cell_valid('text')} AS ok FROM documents)"""
    + _ratio("doc_ok", 0.01, None),
    "cell_ratio": f"WITH {inputs.R_GROUP_ROWS_SQL}, {_CELL_OK}" + _ratio("cell_ok", 0.8, None),
    "attachment_gate": f"WITH {inputs.SCAFFOLDS_SQL}, {inputs.R_GROUP_ROWS_SQL}, {_BRANDS}{_ATTACHMENT}",
    "min_count_gate": inputs.products_sql() + f""", {_BRANDS}
SELECT dataset_id, count(smiles) AS molecule_count, 1500::BIGINT AS minimum_required,
  count(smiles) >= 1500 AS passed
FROM brands LEFT JOIN products USING (dataset_id) GROUP BY 1""",
    "cluster_sizes": f"WITH {_LABELLED} SELECT dataset_id, cluster, count(*) AS size FROM labelled GROUP BY ALL",
    "unlabelled_sizes": """
SELECT o_orderpriority AS dataset_id, -1 AS cluster, count(*) AS size FROM orders GROUP BY 1""",
    "balance_gate": f"WITH {_LABELLED} {_balance('labelled', 0.96)}",
    "embedding_balance": "WITH e AS (SELECT 'embeddings' AS dataset_id, label AS cluster FROM embeddings)"
    + _balance("e", 0.9),
    "input_gate": f"{_INPUT} SELECT dataset_id, gate, passed FROM reports",
    "gate_reports": f"{_INPUT} SELECT dataset_id, gate, passed, report FROM reports",
    "failures": f"""{_INPUT},
failed AS (SELECT dataset_id, arg_min(gate, step) AS stage, arg_min(report, step) AS error
  FROM reports WHERE NOT passed GROUP BY 1)
SELECT dataset_id, stage, 'run-1' AS run_id, error,
  'https://logs.example/runs/run-1/' || stage || '/' || dataset_id AS log_url,
  'library, run run-1: dataset ' || dataset_id || ' stopped at ' || stage || chr(10) || 'Figures: ' || error
    || chr(10) || 'Log: https://logs.example/runs/run-1/' || stage || '/' || dataset_id AS message
FROM failed""",
    "first_failure": f"""{_INPUT}
SELECT dataset_id, arg_min(gate, step) AS gate FROM reports WHERE NOT passed GROUP BY 1""",
    "run_datasets": f"""{_INPUT}
SELECT 'run-1' AS run_id, dataset_id, bool_and(passed) AS passed FROM reports GROUP BY 2""",
    "run_summary": f"""{_INPUT},
ids AS (SELECT dataset_id, bool_and(passed) AS ok FROM reports GROUP BY 1)
SELECT 'library' AS pipeline_id, 'run-1' AS run_id, count(*) AS discovered,
  count(*) FILTER (ok) AS passed,
  count(*) || ' dataset(s) run, ' || count(*) FILTER (ok) || ' through every gate' AS headline
FROM ids""",
}
