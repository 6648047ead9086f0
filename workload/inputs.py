"""Library inputs derived from the given tables, once in Spark and once in SQL.

A dataset is a brand. Suppliers become scaffolds (dataset by nation), parts become fragment rows with
two labels. Some rows are blank, invalid or of the wrong arity on purpose. The derived tables are
written once, so that the operators start from a table and not from its derivation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.session import materialised

LABELS = ["R1", "R2"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    body = F.expr("repeat('C', cast(floor(abs(s_acctbal)) as bigint) % 9)")
    smiles = (
        F.when(key % 20 == 7, F.lit("  "))
        .when(key % 20 == 13, F.lit("NOT_A_MOLECULE"))
        .when(key % 10 == 9, F.concat(F.lit("c1ccncc1"), body, F.lit("[*:1]")))
        .when(key % 3 == 0, F.concat(F.lit("[*:1]C"), body, F.lit("c1ccc([*:2])cc1")))
        .when(key % 3 == 1, F.concat(F.lit("[*:2]N"), body, F.lit("C1CCC(O[*:1])CC1")))
        .otherwise(F.concat(F.lit("O=C(C"), body, F.lit("[*:1])N[*:2]")))
    )
    return materialised(table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Brand#"), F.col("s_nationkey") + 1).alias("dataset_id"),
        key.alias("scaffold_id"),
        smiles.alias("smiles"),
    ))


def r_group_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, name, kind = F.col("p_size"), F.col("p_name"), F.col("p_type")
    tail = (
        F.when(kind == "ECONOMY", "O")
        .when(kind == "SMALL", "N")
        .when(kind == "MEDIUM", "F")
        .when(kind == "LARGE", "Cl")
        .when(kind == "PROMO", "c1ccccc1")
        .otherwise("C(=O)O")
    )
    end = (
        F.when(name.endswith("bolt"), "F")
        .when(name.endswith("ring"), "Br")
        .when(name.endswith("widget"), "C#N")
        .otherwise("[NH3+]")
    )
    return materialised(table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("dataset_id"),
        F.col("p_partkey").alias("pos"),
        F.when(size % 25 == 0, F.lit(None))
        .otherwise(F.concat(F.lit(" [*:1]C"), F.expr("repeat('C', p_size % 6)"), tail))
        .alias("R1"),
        F.when(name.startswith("red ") & (size % 7 == 0), F.lit("NOT_A_FRAGMENT"))
        .when(name.startswith("blue ") & (size % 11 == 0), F.lit(""))
        .otherwise(F.concat(F.lit("[*:2]C"), F.expr("repeat('C', p_size % 11)"), end))
        .alias("R2"),
    ))


SCAFFOLDS_SQL = """
scaffolds AS (
  SELECT 'Brand#' || (s_nationkey + 1) AS dataset_id, s_suppkey AS scaffold_id,
    CASE
      WHEN s_suppkey % 20 = 7 THEN '  '
      WHEN s_suppkey % 20 = 13 THEN 'NOT_A_MOLECULE'
      WHEN s_suppkey % 10 = 9 THEN 'c1ccncc1' || body || '[*:1]'
      WHEN s_suppkey % 3 = 0 THEN '[*:1]C' || body || 'c1ccc([*:2])cc1'
      WHEN s_suppkey % 3 = 1 THEN '[*:2]N' || body || 'C1CCC(O[*:1])CC1'
      ELSE 'O=C(C' || body || '[*:1])N[*:2]' END AS smiles
  FROM (SELECT *, repeat('C', (floor(abs(s_acctbal))::BIGINT % 9)) AS body FROM supplier)
)"""

R_GROUP_ROWS_SQL = """
r_group_rows AS (
  SELECT p_brand AS dataset_id, p_partkey AS pos,
    CASE WHEN p_size % 25 = 0 THEN NULL ELSE ' [*:1]C' || repeat('C', p_size % 6) ||
      CASE p_type WHEN 'ECONOMY' THEN 'O' WHEN 'SMALL' THEN 'N' WHEN 'MEDIUM' THEN 'F'
        WHEN 'LARGE' THEN 'Cl' WHEN 'PROMO' THEN 'c1ccccc1' ELSE 'C(=O)O' END END AS R1,
    CASE WHEN p_name LIKE 'red %' AND p_size % 7 = 0 THEN 'NOT_A_FRAGMENT'
      WHEN p_name LIKE 'blue %' AND p_size % 11 = 0 THEN ''
      ELSE '[*:2]C' || repeat('C', p_size % 11) ||
        CASE WHEN p_name LIKE '%bolt' THEN 'F' WHEN p_name LIKE '%ring' THEN 'Br'
          WHEN p_name LIKE '%widget' THEN 'C#N' ELSE '[NH3+]' END END AS R2
  FROM part
)"""


def valid_sql(text: str) -> str:
    """The text kernel's validity check; blank and null are not valid."""
    bare = rf"regexp_replace({text}, '\[[^\[\]]*\]', '', 'g')"
    marks = rf"regexp_replace({bare}, '[^()]', '', 'g')"
    labels = rf"list_transform(regexp_extract_all({bare}, '%[0-9]{{2}}|[0-9]'), lambda c: replace(c, '%', '')::INT)"
    deep = f"list_transform(range(1, length({marks}) + 1), lambda i: length(replace(left({marks}, i), ')', '')) * 2 - i)"
    return (
        rf"coalesce(regexp_matches({text}, '^(?:\[[^\[\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]|\*|[0-9]|%[0-9]{{2}}"
        rf"|[-=#$:/\\.()])+$')"
        rf" AND len(replace({marks}, '(', '')) * 2 = len({marks}) AND coalesce(list_min({deep}), 0) >= 0"
        rf" AND len(list_filter(list_distinct({labels}), lambda l: len(list_filter({labels}, lambda m: m = l)) % 2 = 1)) = 0, false)"
    )


def points_sql(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '\*'))"


def weld_sql(text: str) -> str:
    first = (
        rf"regexp_replace({text}, '^\[\*:([1-9])\](\[[^\]]+\]|Br|Cl|[A-Za-z])', '\2-%9\1')"
    )
    branch = rf"regexp_replace({first}, '\(\[\*:([1-9])\]\)', '-%9\1', 'g')"
    return rf"regexp_replace({branch}, '\[\*:([1-9])\]', '-%9\1', 'g')"


UNWELDABLE_SQL = r"^-%9|[)=#$:/\\]-%9|@[^\[\]]*\]-%9|\*"

# Fragment rows with every cell usable, and each fragment's index under its label.
R_GROUPS_SQL = (
    R_GROUP_ROWS_SQL
    + rf""",
clean AS (
  SELECT dataset_id, pos, trim(coalesce(R1, '')) AS R1, trim(coalesce(R2, '')) AS R2
  FROM r_group_rows
),
usable_rows AS (
  SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY pos) - 1 AS idx,
    count(*) OVER (PARTITION BY dataset_id) AS n
  FROM clean WHERE {valid_sql('R1')} AND {valid_sql('R2')}
)"""
)


def _part_sql(text: str) -> str:
    """A part's welded text, whether it can't be joined, and its labels counted in base 16, up to 3 each."""
    counts = " + ".join(
        f"least(3, len(regexp_extract_all({weld_sql(text)}, '%9{k}')))::BIGINT * {16 ** (k - 1)}" for k in range(1, 10)
    )
    bad = f"regexp_matches({weld_sql(text)}, '{UNWELDABLE_SQL}') OR regexp_matches({text}, '%9[1-9]')"
    return f"{weld_sql(text)} AS w, {bad} AS bad, {counts} AS k"


def attempts_sql(cap: int | None = None) -> str:
    """Every attempt in mixed-radix order by joining both labels, under the cap if there is one."""
    first, second = (f"AND a.idx * a.n < {cap}", f"AND a.idx * a.n + b.idx < {cap}") if cap else ("", "")
    # Every label must occur twice or not at all: no bit but the second of any digit.
    odd = sum(0xD * 16**k for k in range(9))
    return (
        "WITH "
        + SCAFFOLDS_SQL
        + ","
        + R_GROUPS_SQL
        + rf""",
usable_scaffolds AS MATERIALIZED (
  SELECT dataset_id, scaffold_id, {_part_sql('trim(smiles)')} FROM scaffolds
  WHERE trim(smiles) <> '' AND {valid_sql('trim(smiles)')} AND {points_sql('trim(smiles)')} = 2
),
firsts AS MATERIALIZED (SELECT *, {_part_sql('R1')} FROM usable_rows),
seconds AS MATERIALIZED (SELECT *, {_part_sql('R2')} FROM usable_rows),
attempts AS (
  SELECT s.dataset_id, s.scaffold_id, a.idx * a.n + b.idx AS ord, a.R1, b.R2,
    CASE WHEN NOT (s.bad OR a.bad OR b.bad) AND (s.k + a.k + b.k) & {odd} = 0
      THEN s.w || '.' || a.w || '.' || b.w END AS smiles
  FROM usable_scaffolds s
  JOIN firsts a ON a.dataset_id = s.dataset_id {first}
  JOIN seconds b ON b.dataset_id = s.dataset_id {second}
)"""
    )


def products_sql(cap: int | None = None) -> str:
    """Distinct products, first seen first."""
    return (
        attempts_sql(cap)
        + """,
products AS (
  SELECT dataset_id, scaffold_id, ord, smiles, R1, R2 FROM attempts WHERE smiles IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dataset_id, smiles ORDER BY scaffold_id, ord) = 1
)"""
    )


def descriptors_sql(source: str, name: str = "described") -> str:
    """The seven text descriptors, counted with regular expressions over `source.smiles`."""
    bracket = r"\[[0-9]*(?:[A-GI-Z][a-z]?|H[efgos]|[bcnops])[^\[\]]*\]"

    def count(pattern: str, text: str = "bare") -> str:
        return f"len(regexp_extract_all({text}, '{pattern}'))"

    def atoms(symbol: str) -> str:
        inside = rf"\[[0-9]*{symbol}(?:[^a-z\[\]][^\[\]]*)?\]"
        return count(inside, "smiles")

    heavy = f"({count('Br|Cl|[BCNOPSFIbcnops]')} + {count(bracket, 'smiles')})"
    one_letter = {"B": "Bb", "N": "Nn", "O": "Oo", "P": "Pp", "S": "Ss", "F": "F", "I": "I"}
    weights = {"B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "P": 30.974, "S": 32.06,
               "F": 18.998, "Cl": 35.45, "Br": 79.904, "I": 126.9}
    counts = {s: f"({count('[' + c + ']', 'single')} + {atoms('[' + c + ']')})" for s, c in one_letter.items()}
    counts["C"] = f"({count('[Cc]', 'single')} + {atoms('[Cc]')})"
    counts["Cl"] = f"({count('Cl')} + {atoms('Cl')})"
    counts["Br"] = f"({count('Br')} + {atoms('Br')})"
    weight = " + ".join(f"{counts[s]} * {w}::DOUBLE" for s, w in weights.items())
    halogens = " + ".join(counts[s] for s in ("F", "Cl", "Br", "I"))
    return rf"""
{name} AS (
  SELECT * EXCLUDE (bare, single),
    {heavy}::DOUBLE AS n_heavy_atoms,
    ({heavy} - {counts['C']})::DOUBLE AS n_hetero_atoms,
    ({halogens})::DOUBLE AS n_halogens,
    ({count('[bcnops]', 'single')} + {atoms('[bcnops]')})::DOUBLE AS n_aromatic_atoms,
    ({count('%[0-9]{2}|[0-9]')} / 2 - {count(chr(92) + '.')})::DOUBLE AS n_rings,
    {count(chr(92) + '(')}::DOUBLE AS n_branches,
    format('{{:.4f}}', {weight})::DOUBLE AS heavy_atom_weight
  FROM (SELECT *, regexp_replace(bare, 'Br|Cl', 'X', 'g') AS single FROM (
    SELECT *, regexp_replace(smiles, '\[[^\[\]]*\]', '', 'g') AS bare FROM {source}))
)"""
