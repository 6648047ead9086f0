"""Batch prediction and the merge of predictions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.operators import predict
from workload.inputs import table


def length_model():
    """Loader of a linear model on the length of a text and its count of spaces.

    It is built here rather than at module level so that it is shipped to the tasks by value.
    """

    def load():
        def model(texts: pd.Series) -> pd.DataFrame:
            spaces = texts.str.count(" ")
            return pd.DataFrame({"score": texts.str.len() * 3 + spaces * 5 + 1, "spaces": spaces})

        return model

    return load


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset_id"), "doc_id", F.col("text").alias("smiles")
    )


def predict_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = predict.predict(_documents(spark, sf_dir), length_model(), ["score"])
    return scored.drop("smiles")


def predict_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = predict.predict(_documents(spark, sf_dir), length_model(), ["score", "spaces"])
    return scored.drop("smiles")


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality")


def prediction_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the quality label as a prediction; unlabelled ones drop out."""
    docs = _documents(spark, sf_dir).drop("smiles")
    return predict.merge_predictions(docs, _quality(spark, sf_dir), ["doc_id"])


def prediction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return predict.prediction_stats(docs, prediction_merge(spark, sf_dir))


QUERIES = {
    "predict_batch": predict_batch,
    "predict_targets": predict_targets,
    "prediction_merge": prediction_merge,
    "prediction_stats": prediction_stats,
}

_SPACES = "length(text) - length(replace(text, ' ', ''))"
_SCORE = f"length(text) * 3 + ({_SPACES}) * 5 + 1"

ORACLES = {
    "predict_batch": f"""
SELECT source AS dataset_id, doc_id, ({_SCORE})::VARCHAR AS chemprop_prediction FROM documents""",
    "predict_targets": f"""
SELECT source AS dataset_id, doc_id, ({_SCORE})::VARCHAR AS score, ({_SPACES})::VARCHAR AS spaces FROM documents""",
    "prediction_merge": """
SELECT d.source AS dataset_id, d.doc_id, l.quality::VARCHAR AS chemprop_prediction
FROM documents d JOIN labels l USING (doc_id)""",
    "prediction_stats": """
SELECT source AS dataset_id, count(*) AS input, count(l.doc_id) AS predicted
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""",
}
