"""A whole run: find new datasets, check them, enumerate, describe, cluster, publish.

All datasets share one lineage keyed by ``dataset_id``. A dataset that fails a gate is reported and
left out of the later stages; the others go on. Clusters are published only after the last gate, and
a published dataset counts as processed.

A run writes into folders of its own. One small row per dataset, added when all is written, makes them the
current ones; until then, and if the run breaks off, readers see what was there before. Nothing is deleted
but by `remove_unused`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.functions.columns import MOLECULE_ID
from molspark.functions.kernel import Kernel, text_kernel
from molspark.functions.ordering import sorted_position
from molspark.operators import clustering, descriptors, factorised, gates, layers, neighbour_descent, predict, similarity, spanning_tree
from molspark.operators import enumerate as library
from molspark.plans import discover
from molspark.session import materialised
from molspark.sources.listing import list_keys
from molspark.sources.pairs import read_pairs
from molspark.sources.tables import RUN, read_current, remove_runs, write_stage

KEY = "dataset_id"
POINTERS = f"{KEY} STRING, passed BOOLEAN, finished TIMESTAMP, {RUN} STRING"
STAGES = ("molecules", "properties", "clusters", "nodes", "edges", "invalid", "predictions")
GATE_ORDER = (
    "inputs_present",
    "scaffold_validity",
    "r_group_validity",
    "attachment_points",
    "generation",
    "cluster_count",
    "cluster_balance",
    "graph_rows",
)


@dataclass(frozen=True)
class RunConfig:
    input_base: str
    output_base: str
    dataset_id: str = ""
    overwrite: bool = False
    n_clusters: int = clustering.DEFAULT_K
    auto_k_range: tuple[int, int] | None = None
    max_products: int | None = None
    min_valid_ratio: float = gates.MIN_VALID_RATIO
    min_products: int = gates.MIN_PRODUCTS
    max_dominant_ratio: float = gates.MAX_DOMINANT_RATIO
    features: Sequence[str] | None = None
    with_graph: bool = True
    graph: dict = field(default_factory=dict)
    fingerprint: str | None = None
    log_base: str | None = None
    predictor: predict.Loader | None = None
    targets: Sequence[str] = ("prediction",)
    run_id: str = "run"


def pointers(spark: SparkSession, output_base: str) -> DataFrame:
    """(dataset_id, passed, run) of each dataset's latest finished run, from the small table that every run
    adds its datasets to."""
    try:
        runs = spark.read.schema(POINTERS).parquet(f"{output_base}/processed")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{KEY} STRING, passed BOOLEAN, {RUN} STRING")
    latest = runs.groupBy(KEY).agg(F.max_by(F.struct("passed", RUN), "finished").alias("last"))
    return latest.select(KEY, "last.passed", f"last.{RUN}")


def published(spark: SparkSession, output_base: str) -> DataFrame:
    """Ids whose latest run passed."""
    return pointers(spark, output_base).where("passed").select(KEY)


def current(spark: SparkSession, output_base: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A stage's rows of every dataset's latest finished run."""
    path = f"{output_base.rstrip('/')}/{name}"
    if schema is None:
        schema = T.StructType([f for f in spark.read.option("mergeSchema", True).parquet(path).schema if f.name not in (RUN, KEY)])
        schema = schema.add(KEY, "string")
    return read_current(spark, path, schema, pointers(spark, output_base.rstrip("/")))


def remove_unused(spark: SparkSession, output_base: str) -> list[str]:
    """Delete the folders of runs that are no dataset's latest; not while another run is writing."""
    out = output_base.rstrip("/")
    used = [r[0] for r in pointers(spark, out).select(RUN).distinct().collect()]
    return remove_runs(spark, [f"{out}/{name}" for name in STAGES], used)


def process_datasets(spark: SparkSession, config: RunConfig, kernel: Kernel | None = None) -> dict[str, DataFrame]:
    """Run everything and return the written tables by name."""
    kernel = kernel or text_kernel()
    out = config.output_base.rstrip("/")
    features = list(config.features or kernel.descriptor_names)

    keys = materialised(list_keys(spark, config.input_base, "*.csv"))
    wanted = discover.candidate(spark, keys, config.dataset_id)
    ids, skipped = discover.discover(wanted, published(spark, out), config.overwrite)
    ids = materialised(ids)

    # Each report table is written once and extended stage by stage.
    absent = discover.missing_inputs(ids, keys).groupBy(KEY).agg(F.count(F.lit(1)).alias("missing"))
    present = (
        ids.join(absent, KEY, "left")
        .fillna(0, ["missing"])
        .withColumn("passed", F.col("missing") == 0)
    )
    reports = [materialised(gates.as_report(present, "inputs_present"))]
    alive = gates.passing(ids, reports[-1])

    scaffolds, cells = (materialised(t) for t in read_pairs(spark, config.input_base, alive))
    labels = cells.groupBy(KEY).agg(F.count_distinct("label").cast("int").alias("n_labels"))
    reports.append(
        materialised(
            gates.input_gate(scaffolds, cells, labels, kernel, config.min_valid_ratio, alive)
        )
    )
    alive = materialised(gates.passing(alive, reports[-1]))

    fragments = materialised(library.load_r_group_cells(cells.join(alive, KEY, "left_semi"), kernel))
    usable = scaffolds.join(alive, KEY, "left_semi")
    molecules = factorised.enumerate_library(usable, fragments, kernel, config.max_products)
    possible = library.possible_counts(usable, fragments, kernel)
    if config.max_products is None:
        generation = factorised.attempt_counts(usable, fragments, kernel).join(possible, KEY)
    else:
        made = library.attempts(usable, fragments, kernel, config.max_products)
        generation = library.enumeration_stats(made, possible)
    run = f"{config.run_id}-{uuid.uuid4().hex}"
    schemas: dict[str, T.StructType] = {}

    def stage(df: DataFrame, name: str) -> DataFrame:
        schemas[name] = df.schema
        return spark.read.schema(df.schema).parquet(write_stage(df, f"{out}/{name}", run))

    molecules = stage(molecules, "molecules")
    skipped_scaffolds = library.match_arity(usable, labels, kernel).where("NOT usable")
    reports.append(
        materialised(
            gates.as_report(gates.min_count_gate(molecules, config.min_products, alive), "generation")
        )
    )
    alive = materialised(gates.passing(alive, reports[-1]))

    described = descriptors.with_descriptors(molecules.join(alive, KEY, "left_semi"), kernel)
    properties = stage(described, "properties")
    points = sorted_position(properties, [KEY, "scaffold_id", "ord"], clustering.ID)
    least = 1 if config.auto_k_range else config.n_clusters
    enough = clustering.check_k(points, least).withColumnRenamed("enough", "passed")
    reports.append(materialised(gates.as_report(_all(alive, enough), "cluster_count")))
    alive = materialised(gates.passing(alive, reports[-1]))

    clustered = materialised(
        clustering.cluster_rows(
            points.join(alive, KEY, "left_semi"),
            features,
            config.n_clusters,
            check=False,
            auto_k_range=config.auto_k_range,
        )
    )
    sizes = gates.cluster_sizes(clustered)
    reports.append(
        materialised(
            gates.as_report(
                gates.balance_gate(sizes, config.max_dominant_ratio, alive), "cluster_balance"
            )
        )
    )
    alive = materialised(gates.passing(alive, reports[-1]))
    good = clustered.join(alive, KEY, "left_semi")
    tables = {
        "generation_stats": materialised(generation),
        # Scaffolds that no combination was made of: not valid, or of another arity than the dataset has labels.
        "skipped_scaffolds": materialised(skipped_scaffolds.drop("usable")),
    }
    stage(good.drop(clustering.ID), "clusters")
    asked = None if config.auto_k_range else config.n_clusters
    tables["cluster_stats"] = clustering.cluster_stats(good, features, asked)

    if config.with_graph:
        graph = build_graph(good, kernel, config.fingerprint, **config.graph)
        written = {name: stage(table, name) for name, table in graph.items()}
        usable = gates.min_count_gate(written["nodes"], 1, alive)
        reports.append(materialised(gates.as_report(usable, "graph_rows")))
    if config.predictor is not None:
        scored = predict.predict(good, config.predictor, config.targets, check=False)
        stage(scored.drop(clustering.ID), "predictions")

    all_reports = materialised(gates.union_reports(reports))
    failures = gates.first_failures(all_reports, GATE_ORDER)
    datasets = gates.run_datasets(ids, alive, config.run_id)
    tables |= {
        "reports": all_reports,
        "failures": gates.failure_records(failures, "library", config.run_id, config.log_base),
        "run_datasets": datasets,
        "run_summary": gates.run_summary(datasets, "library", config.run_id),
        "skipped": skipped,
    }
    for name in ("reports", "failures", "run_datasets", "run_summary"):
        tables[name].write.mode("overwrite").parquet(f"{out}/runs/{config.run_id}/{name}")
    finished = datasets.select(KEY, "passed", F.current_timestamp().alias("finished"), F.lit(run).alias(RUN))
    finished.coalesce(1).write.mode("append").parquet(f"{out}/processed")
    return tables | {name: current(spark, out, name, schema) for name, schema in schemas.items()}


def _all(ids: DataFrame, gate: DataFrame) -> DataFrame:
    """Give datasets without rows a failed entry."""
    return ids.join(gate, KEY, "left").fillna(0, ["n"]).fillna(False, ["passed"])


def build_graph(
    clustered: DataFrame, kernel: Kernel, fingerprint: str | None = None, search: str = "descent", **options
) -> dict[str, DataFrame]:
    """Nodes with labels and colour layers, edges with tree marks, and the rows left out.

    `search` is "descent", or "forest" for the candidates of a forest alone: one pass, but of lower recall.
    `options` are those of the search. Each fragment label is a layer; there are only as many as the widest input has columns.
    """
    found = clustered.select(F.explode(F.map_keys("r_groups")).alias("label")).distinct()
    fragments = sorted(r["label"] for r in found.collect())
    rows = (
        clustered.withColumns({c: F.col("r_groups")[c] for c in fragments if c not in clustered.columns})
        .drop("r_groups", "scaffold_id", "ord")
        .withColumn(MOLECULE_ID, F.concat(F.lit("mol_"), F.col(clustering.ID)))
    )
    valid, invalid = similarity.split_valid(rows, kernel, fingerprint)
    nodes = valid.select(KEY, F.col(clustering.ID).alias("id"), "fingerprint")
    try:
        graph = {"descent": neighbour_descent.descent_graph, "forest": similarity.neighbour_graph}[search]
    except KeyError:
        raise ValueError(f"The search is 'descent' or 'forest', not {search!r}.") from None
    edges, copies = graph(nodes, **options)
    edges = materialised(edges)
    tree = spanning_tree.spanning_forest(edges).select(KEY, "src", "dst", F.lit(True).alias("_tree"))
    marked = edges.join(tree, [KEY, "src", "dst"], "left").select(
        KEY, "src", "dst", "dist", F.coalesce("_tree", F.lit(False)).alias("in_tree")
    )
    coloured, _ = layers.colour_layers(valid.drop("fingerprint"), clustering.ID, [KEY])
    return {
        "nodes": coloured.join(nodes.withColumnRenamed("id", clustering.ID), [KEY, clustering.ID])
        .withColumnRenamed(MOLECULE_ID, "molecule_id"),
        "edges": marked.unionByName(copies.withColumn("in_tree", F.lit(True))),
        "invalid": invalid.withColumnRenamed(MOLECULE_ID, "molecule_id"),
    }
