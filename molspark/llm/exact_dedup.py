"""Exact copies, with the heavy hitters split off (operator 3).

A frequent-items sketch (the Misra-Gries family: counters that are decremented together, here Spark's
approx_top_k) over 64-bit digests names the digests that may be frequent. Their winners are computed
exactly, verified by SHA-256 of the whole normalised text, and broadcast, so copies of a frequent text
are settled where they are read. All other digests go through one ordinary shuffle. The sketch only
decides which way a row takes: the result is the same whatever it names.

Defined cases: null text counts as empty; a null doc_id is larger than any other, so it stays only
when all ids of its group are null (keep_id is null then); of repeated rows with the staying doc_id
exactly one stays; an empty table gives no rows; other columns don't matter and may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from molspark.llm.common import id_and_text, normalised, unused
from molspark.session import materialised

HEAVY = 1024  # digests split off at most; the bound of what is broadcast
TRACKED = 16_384  # counters of the sketch


def _frequent(digests: DataFrame, heavy: int) -> DataFrame:
    """At most `heavy` digests that the sketch saw more than once."""
    top = digests.agg(F.expr(f"approx_top_k(digest, {heavy}, {max(heavy, TRACKED)})").alias("top"))
    return top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("digest"))


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    flat = normalised(F.col("text"))
    return (
        id_and_text(docs, id_col, text_col)
        .withColumn("text", flat)
        .select(
            "doc_id",
            F.unhex(F.sha2("text", 256)).alias("sha"),
            F.xxhash64("text").alias("digest"),
        )
    )


def _winners(rows: DataFrame, heavy: int) -> DataFrame:
    """(sha, keep_id, group_size) of the frequent texts; at most `heavy` digests, so it can be broadcast."""
    return (
        rows.join(F.broadcast(_frequent(rows, heavy)), "digest", "left_semi")
        .groupBy("sha")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = materialised(_digested(docs, id_col, text_col).withColumn("rid", F.monotonically_increasing_id()))
    winners = materialised(_winners(rows, heavy))
    marked = rows.join(F.broadcast(winners), "sha", "left")
    settled = marked.where("group_size IS NOT NULL AND keep_id IS NOT NULL AND NOT (doc_id <=> keep_id)")
    rest = marked.where("group_size IS NULL OR keep_id IS NULL OR doc_id <=> keep_id")
    # Frequent winners are settled but for repeated rows of the winning id: the first row number stays.
    firsts = (
        rest.where("group_size IS NOT NULL").groupBy(F.col("sha").alias("_sha")).agg(F.min("rid").alias("first"))
    )
    heavy_kept = rest.where("group_size IS NOT NULL").join(
        F.broadcast(firsts), F.col("sha") == F.col("_sha")
    )
    group = Window.partitionBy("sha")
    light = (
        rest.where("group_size IS NULL")
        .withColumn("keep_id", F.min("doc_id").over(group))
        .withColumn("group_size", F.count("*").over(group))
        .withColumn("n", F.row_number().over(group.orderBy(F.col("doc_id").asc_nulls_last(), "rid")))
    )

    def out(df: DataFrame, kept) -> DataFrame:
        return df.select(
            "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
        )

    return (
        out(settled, F.lit(False))
        .unionByName(out(heavy_kept, F.col("rid") == F.col("first")))
        .unionByName(out(light, F.col("n") == 1))
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The rows that stay, with the columns of `docs`.

    Copies of frequent texts go on the map side; what is left is shuffled once by its digest.
    """
    sha, keep, number = (unused(c, docs) for c in ("_sha", "_keep_id", "_number"))
    winners = materialised(_winners(materialised(_digested(docs, id_col, text_col)), heavy)).select(
        F.col("sha").alias(sha), F.col("keep_id").alias(keep), F.lit(True).alias(number)
    )
    doc_id = F.col(f"`{id_col}`").cast("bigint")
    marked = docs.withColumn(sha, F.unhex(F.sha2(normalised(F.col(f"`{text_col}`")), 256))).join(
        F.broadcast(winners), sha, "left"
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    light = (
        marked.where(F.col(number).isNull())
        .withColumn(
            number,
            F.row_number().over(
                Window.partitionBy(sha).orderBy(doc_id.asc_nulls_last(), F.xxhash64(*columns))
            ),
        )
        .where(F.col(number) == 1)
        .select(*columns)
    )
    frequent = (
        marked.where(F.col(number).isNotNull() & doc_id.eqNullSafe(F.col(keep)))
        .dropDuplicates([sha])
        .select(*columns)
    )
    return light.unionByName(frequent)
