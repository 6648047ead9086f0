"""Document quality with hierarchical empirical Bayes over sites (operator 7).

A logistic classifier on counts of each whole text gives the document's own evidence. Documents are
summed by site and by path within it, in one grouped aggregation. A site's share of good documents is
shrunk towards the global share, a path's towards its site's, with strengths estimated from how much
sites differ (method of moments); so sparse sites say little. A document's score is its own log odds
plus the log odds of its path over the global ones, the document itself left out of its path and site.

The classifier is fitted on at most SAMPLE labelled rows (those of smallest hash of the id); all
sums cover every document.

Defined cases: null text counts as empty; null site and path are a site and a path like any other; a
null doc_id is scored but never labelled; repeated rows are rows; without labels of both classes the
classifier says the global share of its labels (1 without any), so nothing is rejected; empty tables
give no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molspark.llm.common import by_batch, column, raw, unused
from molspark.session import materialised

SAMPLE = 20_000
REJECT_BELOW = 0.5
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
PLAIN = LETTERS + DIGITS + b" \t\n\v\f\r.,;:'\"()-?"


def features(text: bytes | None) -> list[float]:
    """Shares and means over the whole text that tell prose from lists, noise and repetition."""
    text = text or b""
    n, tokens = max(1, len(text)), text.split()
    count = max(1, len(tokens))
    upper = len(text) - len(text.translate(None, UPPER))
    letters = max(1, len(text) - len(text.translate(None, LETTERS)))
    odd = len(text.translate(None, PLAIN))
    digits = len(text) - len(text.translate(None, DIGITS))
    lines = [line for line in text.split(b"\n") if line]
    repeats = sum(map(eq, tokens, tokens[1:]))
    distinct = len(set(tokens))
    return [
        np.log1p(len(tokens)),
        upper / letters,
        odd / n,
        digits / n,
        repeats / count,
        distinct / count,
        np.log1p(distinct) / np.log1p(count),
        letters / count / 10,
        text.count(b"!") / count,
        text.count(b"|") / count,
        (text.count(b".") + text.count(b",")) / count,
        len(set(lines)) / max(1, len(lines)),
        len(lines) / count,
    ]


def _widened(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.abs(x))])


class Classifier:
    """Logistic regression on standardised features, by damped Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30):
        share = float(y.mean()) if len(y) else 1.0
        self.constant = None if 0 < share < 1 else share
        if self.constant is not None:
            return
        x = _widened(x)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        x = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        self.w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ self.w, -30, 30)))
            gradient = x.T @ (p - y) + ridge * self.w
            curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(self.w))
            step = np.linalg.solve(curve, gradient)
            self.w -= step
            if np.abs(step).max() < 1e-6:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Probability that a document is good, kept away from 0 and 1."""
        if self.constant is not None:
            return np.full(len(x), min(max(self.constant, 1e-4), 1 - 1e-4))
        z = (_widened(x) - self.mean) / self.scale @ self.w[:-1] + self.w[-1]
        return np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-4, 1 - 1e-4)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Classifier:
    """The classifier, from at most `sample` labelled documents; their features reach the driver. Of rows
    that share a labelled id the one of smallest text hash counts."""
    picked = (
        labels.select(column(labels, "doc_id", "bigint").alias("doc_id"), column(labels, label, "double").alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select(column(docs, "doc_id", "bigint").alias("doc_id"), column(docs, "text", "string").alias("text"))
    joined = rows.join(F.broadcast(picked), "doc_id").withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            own = {c: batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "y", "th")}
            return own | {"x": [features(t) for t in raw(batch, "text")]}

        return work

    found = by_batch(joined, "doc_id bigint, y double, th bigint, x array<float>", make)
    one = found.groupBy("doc_id", "y").agg(F.min_by("x", "th").alias("x"))
    got = one.select("y", "x").orderBy("y", "x").collect()
    x = np.array([r[1] for r in got], float).reshape(len(got), len(features(b"")))
    return Classifier(x, np.array([r[0] for r in got], float))


def _with_own(docs: DataFrame, text: str, p: str, model: Classifier) -> DataFrame:
    """`docs` with the classifier's probability as one more column."""
    schema = T.StructType([*docs.schema.fields, T.StructField(p, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in raw(batch, text)], float).reshape(batch.num_rows, -1)
            own = pa.array(model(x)) if batch.num_rows else pa.array([], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, p])

    return docs.mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def sites(scored: DataFrame) -> tuple[DataFrame, float, float, float]:
    """The table of paths with the sums of their site; the global share and the two strengths.

    `scored` has site, path and p. Six numbers reach the driver.
    """
    paths = materialised(
        scored.groupBy("site", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good"))
    )
    hosts = materialised(paths.groupBy("site").agg(F.sum("n").alias("site_n"), F.sum("good").alias("site_good")))

    def strength(table: DataFrame, n: str, good: str) -> tuple[float, float]:
        """Share, and how many documents' worth the prior is: p(1 - p) over the variance between groups."""
        total, count, groups = table.agg(F.sum(good), F.sum(n), F.count("*")).first()
        if not count:
            return 1 - 1e-4, 1.0
        share = min(max(total / count, 1e-4), 1 - 1e-4)
        mean = F.col(good) / F.col(n)
        spread = table.agg(F.sum(F.col(n) * (mean - share) * (mean - share)) / count).first()[0]
        between = spread - share * (1 - share) * groups / count
        return share, min(max(share * (1 - share) / max(between, 1e-9) - 1, 1.0), 1e6)

    share, of_site = strength(hosts, "site_n", "site_good")
    _, of_path = strength(paths, "n", "good")
    joined = paths.withColumnRenamed("site", "s").join(hosts, F.col("s").eqNullSafe(F.col("site"))).drop("s")
    return materialised(joined), share, of_site, of_path


def _posteriors(n, good, site_n, site_good, p, share: float, of_site: float, of_path: float) -> tuple[Column, Column]:
    """Site and path share without the document itself."""
    site = (site_good - p + F.lit(of_site * share)) / (site_n - 1 + F.lit(of_site))
    path = (good - p + F.lit(of_path) * site) / (n - 1 + F.lit(of_path))
    clip = lambda c: F.greatest(F.least(c, F.lit(1 - 1e-4)), F.lit(1e-4))
    return clip(site), clip(path)


def _score(p: Column, path: Column, share: float) -> Column:
    return 1 / (1 + F.exp(-(_logit(p) + _logit(path) - F.lit(float(np.log(share / (1 - share)))))))


def site_of(source: Column) -> Column:
    """The host of a URL; another source is a site by itself."""
    return F.when(source.contains("://"), F.lower(F.regexp_extract(source, "^[^:/]*://([^/?#]*)", 1))).otherwise(source)


def path_of(source: Column, lang: Column) -> Column:
    """The first path segment of a URL; for another source its part in one language."""
    return F.when(source.contains("://"), F.regexp_extract(source, "^[^:/]*://[^/?#]*/([^/?#]*)", 1)).otherwise(lang)


def scores(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, own, site, path, site_posterior, path_posterior, score and rejected for every row."""
    source, lang = column(docs, "source", "string"), column(docs, "lang", "string")
    plain = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"),
        column(docs, "text", "string").alias("text"),
        site_of(source).alias("site"),
        path_of(source, lang).alias("path"),
    )
    own = materialised(_with_own(plain, "text", "p", fit(plain, labels, **how)).drop("text"))
    table, *strengths = sites(own)
    table = table.select(F.col("site").alias("_s"), F.col("path").alias("_p"), "n", "good", "site_n", "site_good")
    joined = own.join(table, F.col("site").eqNullSafe(F.col("_s")) & F.col("path").eqNullSafe(F.col("_p")))
    site, path = _posteriors(*(F.col(c) for c in ("n", "good", "site_n", "site_good", "p")), *strengths)
    score = _score(F.col("p"), F.col("path_posterior"), strengths[0])
    return (
        joined.withColumn("site_posterior", site)
        .withColumn("path_posterior", path)
        .withColumn("score", score)
        .select(
            "doc_id", F.col("p").alias("own"), "site", "path", "site_posterior", "path_posterior", "score",
            (F.col("score") < REJECT_BELOW).alias("rejected"),
        )
    )


def drop_rejected(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows that aren't rejected, with the columns of `docs`.

    The classifier runs once for the sums and once for the decision, so that texts needn't be shuffled:
    only the table of paths meets them, broadcast by its measured size or else by an ordinary join.
    """
    source, lang = column(docs, "source", "string"), column(docs, "lang", "string")
    plain = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"),
        column(docs, "text", "string").alias("text"),
        site_of(source).alias("site"),
        path_of(source, lang).alias("path"),
    )
    model = fit(plain, labels, **how)
    table, *strengths = sites(_with_own(plain.drop("doc_id"), "text", "p", model).drop("text"))
    p = unused("_own", docs)
    names = {c: unused(f"_{c}", docs) for c in ("site", "path", "n", "good", "site_n", "site_good")}
    table = table.select(*(F.col(c).alias(n) for c, n in names.items()))
    joined = _with_own(docs, "text", p, model).join(
        table, site_of(source).eqNullSafe(F.col(names["site"])) & path_of(source, lang).eqNullSafe(F.col(names["path"]))
    )
    _, path = _posteriors(*(F.col(names[c]) for c in ("n", "good", "site_n", "site_good")), F.col(p), *strengths)
    return joined.where(_score(F.col(p), path, strengths[0]) >= REJECT_BELOW).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
