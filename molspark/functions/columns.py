"""Column naming, filling and labelling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.functions.ordering import dense_index

# Accepted column names, and the names they become.
SMILES_ALIASES = ("smiles", "smile", "structure", "canonical_smiles")
ID_ALIASES = ("molecule id", "molecule_id", "mol_id", "compound_id", "name", "id")
SMILES = "smiles"
MOLECULE_ID = "molecule id"


# Everything that counts as outer white space.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Outer white space of any kind removed; null stays null."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def smiles_cell(df: DataFrame) -> Column:
    """The first column called ``smiles``, ignoring case and outer blanks; trimmed, null as blank.
    A frame without such a column gives blanks."""
    for name in df.columns:
        if name.strip().lower() == SMILES:
            return strip(F.coalesce(df[f"`{name}`"], F.lit("")))
    return F.lit("")


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower().strip() for c in df.columns))


def rename_first(df: DataFrame, aliases: Sequence[str], target: str) -> DataFrame | None:
    """Rename the first column found among `aliases`, in frame order; None if there is none."""
    found = next((c for c in df.columns if c in aliases), None)
    if found is None:
        return None
    return df if found == target else df.withColumnRenamed(found, target)


def standard_columns(df: DataFrame, order: str | None = None) -> DataFrame:
    """Normalised names, with ``smiles`` and ``molecule id`` columns.

    Rows without an id column are named ``mol_<position>`` by the integer column `order`.
    """
    named = rename_first(normalise_names(df), SMILES_ALIASES, SMILES)
    if named is None:
        raise ValueError("The input needs a 'smiles' column.")
    with_id = rename_first(named, ID_ALIASES, MOLECULE_ID)
    if with_id is not None:
        return with_id
    if order is None:
        raise ValueError("Rows without an id column need an order column to be numbered by.")
    return with_synthetic_id(named, order)


def with_synthetic_id(df: DataFrame, order: str) -> DataFrame:
    return dense_index(df, order, name="_position").withColumn(
        MOLECULE_ID, F.concat(F.lit("mol_"), F.col("_position").cast("string"))
    ).drop("_position")


def layer_columns(df: DataFrame) -> list[str]:
    """Columns shown as colour layers."""
    return [c for c in df.columns if c not in (SMILES, MOLECULE_ID, "fingerprint")]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.NumericType, T.BooleanType))


def fill_layers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers (null or NaN) become 0; missing values of other types ``N/A``, and those
    become text."""

    def number(c: str) -> Column:
        kind = df.schema[c].dataType
        value = F.col(f"`{c}`")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(0).cast(kind))
        return F.coalesce(value, F.lit(0).cast(kind))

    return df.withColumns(
        {
            c: number(c)
            if is_numeric(df, c)
            else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("N/A"))
            for c in columns
        }
    )


def plain_number(value: Column) -> Column:
    """A double as text: plain decimals from 0.0001 up to below 1e16, else ``d.ddde+xx``."""
    text = value.cast("double").cast("string")
    exponent = F.regexp_extract(text, r"E(-?[0-9]+)$", 1)
    mantissa = F.regexp_replace(text, r"(?:\.0)?E.*$", "")
    whole = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    sign = F.when(exponent.startswith("-"), F.lit("e-")).otherwise(F.lit("e+"))
    digits = F.lpad(F.ltrim(F.replace(exponent, F.lit("-"), F.lit(""))), 2, "0")
    size = F.abs(value.cast("double"))
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), whole)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def label_text(columns: Sequence[str], doubles: Sequence[str] = ()) -> Column:
    """``smiles__ID: id__column: value...`` with backslashes and quotes removed from the values;
    the columns in `doubles` are written by `plain_number`."""

    def plain(column: str) -> Column:
        value = F.col(f"`{column}`")
        text = plain_number(value) if column in doubles else value.cast("string")
        return F.translate(text, "\\\"'", "")

    parts = [plain(SMILES), F.lit("__ID: "), plain(MOLECULE_ID)]
    for c in columns:
        parts += [F.lit(f"__{c}: "), plain(c)]
    return F.concat(*parts)


def doubles_of(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]


# Fixed value: the sentence of the greeting.
def greeting_text(name: str, craft: str, greeting: str) -> Column:
    return F.format_string(
        "%s is currently in space flying on the %s! %s", F.col(name), F.col(craft), F.lit(greeting)
    )


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Wide columns to rows ``(keys, label, smiles)``."""
    cells = [F.struct(F.lit(c).alias("label"), F.col(f"`{c}`").alias("smiles")) for c in columns]
    return df.select(*keys, F.inline(F.array(*cells)))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows under the union of the columns in first-seen order; missing cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
