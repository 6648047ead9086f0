"""Batch scoring with a user's model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: name of the prediction when the model has a single target.
PREDICTION_COLUMN = "chemprop_prediction"

# Builds the model once per task and returns a function from a column of texts to one number or
# text per row and target, in row order.
Loader = Callable[[], Callable[[pd.Series], pd.DataFrame]]


class PredictorNotConfigured(RuntimeError):
    """No model was given; callers skip the stage."""


def prediction_names(targets: Sequence[str], prediction_column: str = PREDICTION_COLUMN) -> list[str]:
    """A single target takes the prediction column's name, several keep their own."""
    return [prediction_column] if len(targets) == 1 else list(targets)


def predict(
    df: DataFrame,
    load: Loader | None,
    targets: Sequence[str],
    smiles_column: str = "smiles",
    prediction_column: str = PREDICTION_COLUMN,
    check: bool = True,
) -> DataFrame:
    """Append the model's targets, as text, replacing columns of the same name.

    Only the text column goes through Python; the model is loaded once per task. Rows stay in their
    partitions, so no join and no shuffle is needed. No rows at all raise, unless `check` is off.
    """
    if load is None:
        raise PredictorNotConfigured("No model configured; skipping prediction.")
    if check and df.isEmpty():
        raise ValueError("There are no rows to predict.")
    names = prediction_names(targets, prediction_column)
    kept = df.drop(*names)
    found = T.StructType([T.StructField(t, T.StringType()) for t in targets])

    @F.pandas_udf(found)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for texts in batches:
            made = model(texts)
            yield pd.DataFrame({t: made[t].astype(str).to_numpy() for t in targets})

    scored = kept.withColumn("_scores", score(F.col(f"`{smiles_column}`")))
    return scored.select(
        *(F.col(f"`{c}`") for c in kept.columns),
        *(F.col("_scores")[t].alias(n) for t, n in zip(targets, names, strict=True)),
    )


def merge_predictions(
    rows: DataFrame,
    predictions: DataFrame,
    on: Sequence[str],
    smiles_column: str = "smiles",
    prediction_column: str = PREDICTION_COLUMN,
) -> DataFrame:
    """Attach predictions made elsewhere, by key. Rows without one are left out; values are text."""
    on = list(on)
    targets = [c for c in predictions.columns if c not in (*on, smiles_column)]
    names = prediction_names(targets, prediction_column)
    values = predictions.select(
        *on, *(F.col(t).cast("string").alias(n) for t, n in zip(targets, names, strict=True))
    )
    return rows.drop(*names).join(values, on)


def prediction_stats(rows: DataFrame, predictions: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Rows given and rows predicted per dataset."""
    given = rows.groupBy(key).agg(F.count(F.lit(1)).alias("input"))
    made = predictions.groupBy(key).agg(F.count(F.lit(1)).alias("predicted"))
    return given.join(made, key, "left").fillna(0, ["predicted"])
