"""Colour layers and labels of graph nodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molspark.functions.columns import doubles_of, fill_layers, is_numeric, label_text, layer_columns
from molspark.functions.lookup import skew_safe_lookup
from molspark.functions.ordering import dense_index

# Fixed value: the layer's name when there is no other.
DEFAULT_LAYER = "Default Map"


def first_seen_index(
    df: DataFrame, column: str, order: str, name: str, keys: Sequence[str] = (), total: int | None = None
) -> DataFrame:
    """Number the values of `column` from 0 in the order in which they first appear.

    `order` is a unique integer column. The dictionary is built with a map-side minimum; the join
    back is safe for values that fill most rows.
    """
    keys = list(keys)
    values = df.groupBy(*keys, column).agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("_uses")
    )
    numbered = dense_index(values, "_first", keys, name).drop("_first")
    numbered = numbered.withColumn(name, F.col(name).cast("int"))
    count = df.count() if total is None else total
    return skew_safe_lookup(df, numbered, [*keys, column], "_uses", count)


def colour_layers(df: DataFrame, order: str, keys: Sequence[str] = ()) -> tuple[DataFrame, dict[str, bool]]:
    """Nodes with a label and one number column per layer, and which layers are categories.

    Numbers stay numbers, other values become their first-seen index. Without layer columns there
    is a single constant one.
    """
    layers = [c for c in layer_columns(df) if c not in (order, *keys)]
    filled = fill_layers(df, layers).withColumn("label", label_text(layers, doubles_of(df, layers)))
    categories = {c: not is_numeric(df, c) for c in layers}
    if not layers:
        return filled.withColumn(DEFAULT_LAYER, F.lit(0.0)), {DEFAULT_LAYER: False}
    total = df.count() if any(categories.values()) else 0
    for c, categorical in categories.items():
        if categorical:
            filled = first_seen_index(filled, c, order, "_index", keys, total).drop(c).withColumnRenamed("_index", c)
        else:
            filled = filled.withColumn(c, F.col(f"`{c}`").cast("double"))
    return filled, categories
