"""File listing, pairing, scans and sinks, column handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.functions import columns
from molspark.plans import discover
from molspark.session import spread, work_path
from molspark.sources import listing, pairs, people, tables
from workload.inputs import table


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys derived from customers and orders: fragments for every building customer and for those
    with a high balance, scaffolds for customers with orders, outputs for finished orders."""
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    folder = F.concat(F.lower("c_mktsegment"), F.lit("/"), F.col("c_custkey"))
    r_groups = customer.where((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") > 3000)).select(
        F.concat(folder, F.lit("_r_groups.csv")).alias("key")
    )
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    scaffolds = bought.select(F.concat(folder, F.lit("_scaffolds.csv")).alias("key"))
    done = bought.where("o_orderstatus = 'F'").select(
        F.concat(F.lit("processed/"), folder, F.lit("/clusters.csv")).alias("key")
    )
    return r_groups.unionByName(scaffolds).unionByName(done).distinct()


KEYS_SQL = """
keys AS (
  SELECT lower(c_mktsegment) || '/' || c_custkey || '_r_groups.csv' AS key FROM customer
  WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 3000
  UNION SELECT lower(c_mktsegment) || '/' || c_custkey || '_scaffolds.csv'
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION SELECT 'processed/' || lower(c_mktsegment) || '/' || c_custkey || '/clusters.csv'
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
),
pairs AS (
  SELECT left(key, length(key) - 14) AS dataset_id FROM keys WHERE key LIKE '%\\_scaffolds.csv' ESCAPE '\\'
  INTERSECT
  SELECT left(key, length(key) - 13) FROM keys WHERE key LIKE '%\\_r\\_groups.csv' ESCAPE '\\'
),
done AS (
  SELECT substr(key, 11, length(key) - 23) AS dataset_id FROM keys WHERE key LIKE 'processed/%/clusters.csv'
)"""


def pair_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.match_pairs(object_keys(spark, sf_dir))


def discover_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("done"), "skipped").otherwise("new")
    paired = discover.dataset_status(object_keys(spark, sf_dir)).where("has_scaffolds AND has_r_groups")
    return paired.select("dataset_id", status.alias("status"))


def discover_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = object_keys(spark, sf_dir)
    new, _ = discover.discover(discover.match_pairs(keys), discover.processed_ids(keys), True)
    return new


def required_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = object_keys(spark, sf_dir)
    ids = table(spark, sf_dir, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.lit("/"), F.col("c_custkey")).alias("dataset_id")
    )
    return discover.missing_inputs(ids, keys)


def object_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the outputs one would want per customer are there."""
    wanted = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("processed/"), F.lower("c_mktsegment"), F.lit("/"), F.col("c_custkey"),
                 F.lit("/clusters.csv")).alias("key"),
    )
    return listing.existing(wanted, object_keys(spark, sf_dir)).select("c_custkey", "key")


DOC_COLUMNS = ["doc_id", "text", "lang", "source"]


def csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, through CSV and back as strings."""
    path = work_path(spark, "documents_csv")
    tables.write_csv(table(spark, sf_dir, "documents").select(*DOC_COLUMNS), path)
    return tables.read_strings(spark, path, DOC_COLUMNS, multi_line=True)


def pair_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text and language through the reader of input pairs: a dataset per source, whole documents
    as cells with their quotes, line breaks and blanks, and the columns in the other order in one file."""
    base = work_path(spark, "pairs")
    docs = table(spark, sf_dir, "documents").withColumn("dataset", F.coalesce("source", F.lit("none")))
    docs = docs.withColumn("cell", F.concat(F.lit('  "'), F.coalesce("text", F.lit("")), F.lit('", ')))
    names = [r["dataset"] for r in docs.select("dataset").distinct().orderBy("dataset").collect()]
    for number, name in enumerate(names):
        own = docs.where(F.col("dataset") == name)
        cells = [F.col("cell").alias(" Smiles "), F.col("doc_id").cast("string").alias("id")]
        for suffix, rows in (
            (discover.SCAFFOLDS_SUFFIX, own.select(*cells[:: -1 if number % 2 else 1])),
            (discover.R_GROUPS_SUFFIX, own.select(F.col("lang").alias("R1"), F.col("cell").alias("R2"), F.col("doc_id").alias("R3"))),
        ):
            # Quoted line breaks keep a file whole, so a dataset is a folder of as many files as there are tasks.
            tables.write_csv(spread(rows), f"{base}/{name}{suffix}")
    listed = spark.createDataFrame([(n,) for n in names], "dataset_id string")
    scaffolds, cells = pairs.read_pairs(spark, base, listed)
    return scaffolds.select("dataset_id", F.lit("scaffold").alias("label"), "smiles").unionByName(
        cells.select("dataset_id", "label", "smiles")
    )


def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "part_csv")
    tables.write_csv(table(spark, sf_dir, "part"), path)
    typed = tables.read_typed(spark, path)
    return typed.withColumns(
        {"p_partkey": F.col("p_partkey").cast("long"), "p_size": F.col("p_size").cast("int")}
    )


def csv_union_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers under one header; cells a side lacks come back as null."""
    path = work_path(spark, "parties_csv")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS key", "concat('  ', c_name, ' ') AS name", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS key", "s_name AS name", "s_nationkey AS nation"
    )
    tables.write_csv([customers, suppliers], path)
    return tables.read_strings(spark, path, ["nation", "segment", "name", "key"])


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON payload per turn: a person per line of the text. System turns are cut off mid-JSON."""
    turns = table(spark, sf_dir, "conversations")
    body = F.to_json(
        F.struct(
            F.col("turn").cast("int").alias("number"),
            F.transform(
                F.split("text", "\n"), lambda line: F.struct(F.col("role").alias("craft"), line.alias("name"))
            ).alias("people"),
        )
    )
    broken = F.col("role") == "system"
    return turns.select(
        "conv_id", "turn", F.when(broken, F.lit('{"number": 1, "peo')).otherwise(body).alias("payload")
    )


def json_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.read_people(payloads(spark, sf_dir))


def event_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k INT")["k"].alias("number")
    )


def greeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people.read_people(payloads(spark, sf_dir))
    return rows.select("conv_id", "turn", columns.greeting_text("name", "craft", "Hello! :)").alias("line"))


def _untidy_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias(" SMILES "),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias(" Compound_ID "),
        F.col("p_type").alias("Structure"),
    )


def smiles_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _untidy_parts(spark, sf_dir)
    return parts.select(F.col("`Part Key`").alias("part_key"), columns.smiles_cell(parts).alias("smiles"))


def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.normalise_names(_untidy_parts(spark, sf_dir))


def alias_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first alias in frame order wins: `structure` comes before `canonical_smiles` here."""
    named = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust"),
        F.col("c_name").alias(" Structure"),
        F.col("c_mktsegment").alias("canonical_smiles"),
        F.col("c_acctbal").alias("Compound_ID "),
    )
    return columns.standard_columns(named)


def synthetic_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey * 7 + 3 AS line", "o_orderpriority AS smiles"
    )
    return columns.standard_columns(orders, order="line")


def _layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("smiles"),
        F.col("p_partkey").alias("molecule id"),
        F.when(F.col("p_size") % 3 > 0, F.col("p_size")).alias("size"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("\\\"it's\" "), F.col("p_type"))).alias("kind"),
        F.when(F.col("p_size") % 7 == 1, F.lit(0.0005))
        .when(F.col("p_size") % 7 == 2, F.lit(12345678.0))
        .when(F.col("p_size") % 7 == 3, F.lit(float("nan")))
        .when(F.col("p_size") % 7 == 4, F.lit(1e-5))
        .when(F.col("p_size") % 7 == 5, F.lit(2.5e16))
        .when(F.col("p_size") < 40, F.col("p_retailprice"))
        .alias("price"),
    )


def layer_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _layered(spark, sf_dir)
    return columns.fill_layers(parts, columns.layer_columns(parts))


def label_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _layered(spark, sf_dir)
    layers = columns.layer_columns(parts)
    return columns.fill_layers(parts, layers).select(
        F.col("`molecule id`").alias("part_key"), columns.label_text(layers, columns.doubles_of(parts, layers)).alias("label")
    )


QUERIES = {
    "pair_match": pair_match,
    "discover_new": discover_new,
    "discover_overwrite": discover_overwrite,
    "required_inputs": required_inputs,
    "object_exists": object_exists,
    "csv_string_scan": csv_string_scan,
    "pair_files": pair_files,
    "csv_typed_scan": csv_typed_scan,
    "csv_union_header": csv_union_header,
    "json_people": json_people,
    "event_numbers": event_numbers,
    "greeting": greeting,
    "smiles_column": smiles_column,
    "normalise_names": normalise_names,
    "alias_rename": alias_rename,
    "synthetic_id": synthetic_id,
    "layer_fill": layer_fill,
    "label_text": label_text,
}

_PEOPLE_SQL = """
turns AS (
  SELECT conv_id, turn, turn::INT AS number, role AS craft, unnest(string_split(text, chr(10))) AS name
  FROM conversations WHERE role <> 'system'
  UNION ALL
  SELECT conv_id, turn, 12, p.craft, p.name FROM conversations, (VALUES %s) p(craft, name)
  WHERE role = 'system'
)""" % ", ".join(f"('{c}', '{n}')" for c, n in people.FALLBACK_PEOPLE)

_LAYERED_SQL = r"""
layered AS (
  SELECT p_name AS smiles, p_partkey AS "molecule id",
    coalesce(CASE WHEN p_size % 3 > 0 THEN p_size END, 0) AS size,
    coalesce(CASE WHEN p_type <> 'PROMO' THEN '\"it''s" ' || p_type END, 'N/A') AS kind,
    CASE p_size % 7 WHEN 1 THEN 0.0005::DOUBLE WHEN 2 THEN 12345678 WHEN 3 THEN 0 WHEN 4 THEN 1e-5 WHEN 5 THEN 2.5e16
      ELSE coalesce(CASE WHEN p_size < 40 THEN p_retailprice END, 0) END AS price
  FROM part
)"""

ORACLES = {
    "pair_match": f"WITH {KEYS_SQL} SELECT * FROM pairs",
    "discover_new": f"""WITH {KEYS_SQL}
SELECT dataset_id, 'new' AS status FROM pairs WHERE dataset_id NOT IN (SELECT dataset_id FROM done)
UNION ALL SELECT dataset_id, 'skipped' FROM pairs WHERE dataset_id IN (SELECT dataset_id FROM done)""",
    "discover_overwrite": f"WITH {KEYS_SQL} SELECT * FROM pairs",
    "required_inputs": f"""WITH {KEYS_SQL},
wanted AS (SELECT lower(c_mktsegment) || '/' || c_custkey AS dataset_id, unnest(['_scaffolds.csv', '_r_groups.csv']) AS s
  FROM customer)
SELECT dataset_id, dataset_id || s AS key FROM wanted WHERE dataset_id || s NOT IN (SELECT key FROM keys)""",
    "object_exists": f"""WITH {KEYS_SQL}
SELECT c_custkey, key FROM customer
JOIN keys ON key = 'processed/' || lower(c_mktsegment) || '/' || c_custkey || '/clusters.csv'""",
    "csv_string_scan": "SELECT doc_id::VARCHAR AS doc_id, text, lang, source FROM documents",
    "pair_files": """WITH c AS (SELECT coalesce(source, 'none') AS dataset_id, doc_id, lang,
  '  "' || coalesce(text, '') || '", ' AS cell FROM documents)
SELECT dataset_id, 'scaffold' AS label, trim(cell) AS smiles FROM c
UNION ALL SELECT dataset_id, 'R1', coalesce(lang, '') FROM c UNION ALL SELECT dataset_id, 'R2', cell FROM c
UNION ALL SELECT dataset_id, 'R3', coalesce(doc_id::VARCHAR, '') FROM c""",
    "csv_typed_scan": "SELECT * FROM part",
    "csv_union_header": """
SELECT c_custkey::VARCHAR AS key, '  ' || c_name || ' ' AS name, c_mktsegment AS segment, NULL::VARCHAR AS nation FROM customer
UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL, s_nationkey::VARCHAR FROM supplier""",
    "json_people": f"WITH {_PEOPLE_SQL} SELECT * FROM turns",
    "event_numbers": "SELECT event_id, (props->>'k')::INT AS number FROM events",
    "greeting": f"""WITH {_PEOPLE_SQL}
SELECT conv_id, turn, name || ' is currently in space flying on the ' || craft || '! Hello! :)' AS line
FROM turns""",
    "smiles_column": "SELECT p_partkey AS part_key, trim(p_name) AS smiles FROM part",
    "normalise_names": """
SELECT p_partkey AS "part key", ' ' || p_name || '  ' AS smiles,
  CASE WHEN p_size > 10 THEN p_brand END AS compound_id, p_type AS structure FROM part""",
    "alias_rename": """
SELECT c_custkey AS cust, c_name AS smiles, c_mktsegment AS canonical_smiles, c_acctbal AS "molecule id"
FROM customer""",
    "synthetic_id": """
SELECT o_orderkey * 7 + 3 AS line, o_orderpriority AS smiles,
  'mol_' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS "molecule id" FROM orders""",
    "layer_fill": f"WITH {_LAYERED_SQL} SELECT * FROM layered",
    "label_text": f"""WITH {_LAYERED_SQL}
SELECT "molecule id" AS part_key, smiles || '__ID: ' || "molecule id" || '__size: ' || size || '__kind: '
  || regexp_replace(kind, '[\\\\"'']', '', 'g') || '__price: ' || price AS label FROM layered""",
}
