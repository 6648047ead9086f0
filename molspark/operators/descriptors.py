"""Descriptor columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.functions.kernel import Kernel
from molspark.functions.rounding import round_exact
from molspark.operators.enumerate import trimmed

# The toolkit descriptor names a chemistry kernel is expected to return, and the
# number of decimals kept.
TOOLKIT_DESCRIPTORS = (
    "mol_weight",
    "log_p",
    "tpsa",
    "hba",
    "hbd",
    "rotatable_bonds",
    "aromatic_rings",
)
DECIMALS = 4


def with_descriptors(df: DataFrame, kernel: Kernel, smiles_column: str = "smiles") -> DataFrame:
    """Append the kernel's descriptors, replacing columns of the same name, and drop rows whose
    text is blank or invalid or lacks a descriptor. Projections and filters: no shuffle."""
    usable = df.withColumn("_text", trimmed(smiles_column)).where(
        (F.col("_text") != "") & kernel.is_valid(F.col("_text"))
    )
    described = kernel.descriptors(usable, "_text").drop("_text")
    whole = {c for c in kernel.descriptor_names if isinstance(described.schema[c].dataType, T.IntegralType)}
    return described.withColumns(
        {
            c: F.col(c).cast("double") if c in whole else round_exact(F.col(c), DECIMALS)
            for c in kernel.descriptor_names
        }
    ).dropna("any", subset=list(kernel.descriptor_names))


def descriptor_stats(
    df: DataFrame, kernel: Kernel, smiles_column: str = "smiles", by: str = "dataset_id"
) -> DataFrame:
    """Input, calculated and failed row counts; a row without all descriptors has failed."""
    given = df.groupBy(by).agg(F.count(F.lit(1)).alias("input"))
    made = with_descriptors(df, kernel, smiles_column).groupBy(by).agg(F.count(F.lit(1)).alias("calculated"))
    return (
        given.join(made, by, "left")
        .fillna(0, ["calculated"])
        .select(by, "input", "calculated", (F.col("input") - F.col("calculated")).alias("failed"))
    )
