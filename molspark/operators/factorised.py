"""The product of scaffolds and fragments through its factors.

A product's text depends on the texts of its parts only. So equal parts are one class, which keeps its
first appearance and how often it occurs, and the distinct products are combinations of classes: their
number doesn't grow with repeated scaffolds and fragments. A product is first made by the first members
of its classes, so its first scaffold and attempt number follow without looking at the other attempts.

For kernels whose products are sums of their parts (`Kernel.additive`) the parts are described, not the
products, and counts, means and deviations of whole datasets come without a single product row: per-part
histograms over the marks that decide whether a combination is possible are convolved label by label.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.functions.kernel import Kernel
from molspark.functions.rounding import round_exact
from molspark.operators import enumerate as library
from molspark.operators.descriptors import DECIMALS, with_descriptors
from molspark.session import materialised

COUNT = "decimal(38,0)"


def scaffold_classes(scaffolds: DataFrame) -> DataFrame:
    """Equal scaffolds of a dataset as one, under the least id, with how many there are."""
    return (
        scaffolds.select("dataset_id", "scaffold_id", library.trimmed("smiles").alias("smiles"))
        .where("smiles <> ''")
        .groupBy("dataset_id", "smiles")
        .agg(F.min("scaffold_id").alias("scaffold_id"), F.count(F.lit(1)).alias("times"))
    )


def fragment_classes(r_groups: DataFrame) -> DataFrame:
    """Equal fragments of a label as one, with the index of the first and how many there are."""
    return (
        library.indexed_r_groups(r_groups)
        .groupBy("dataset_id", "label", "smiles")
        .agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("times"))
    )


def _parts_are_separable(scaffolds: DataFrame, fragments: DataFrame, kernel: Kernel) -> bool:
    """Whether combinations of different classes are different products."""
    if kernel.additive is None:
        return False
    texts = scaffolds.select("smiles").unionByName(fragments.select("smiles"))
    return texts.where(~kernel.additive.separable(F.col("smiles"))).isEmpty()


def _described(df: DataFrame, kernel: Kernel, part: str = "prepared") -> DataFrame:
    """A struct of the descriptors of a prepared part, as doubles."""
    values = F.struct(*(F.col(c).cast("double").alias(c) for c in kernel.descriptor_names))
    return kernel.additive.describe(df, part).withColumn("values", values).drop(*kernel.descriptor_names)


def _joined_values(kernel: Kernel) -> dict[str, Column]:
    """The descriptors of a product: those of its scaffold and its fragments, and of the joints."""

    def total(c: str) -> Column:
        fixed = kernel.additive.joint.get(c, 0.0)
        return F.aggregate("fragments", F.col("values")[c], lambda sum_, f: sum_ + f["values"][c] + F.lit(fixed))

    return {c: total(c) for c in kernel.descriptor_names}


def distinct_library(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel, describe: bool = False) -> DataFrame:
    """All distinct products of each dataset, each under the first scaffold and attempt that makes it; with
    `describe` and the kernel's descriptors.

    The combinations of classes are decoded in chunks like attempts are. If products of different classes
    may be equal, the first of equal ones is chosen among those few; otherwise there is nothing to choose.
    """
    scaffolds = materialised(scaffold_classes(scaffolds))
    fragments = materialised(fragment_classes(r_groups))
    separable = _parts_are_separable(scaffolds, fragments, kernel)
    additive = describe and separable
    sizes = _all_sizes(fragments)
    # A part that can't be joined is in no product.
    usable = fragments.withColumn("prepared", kernel.prepare(F.col("smiles"))).where("prepared IS NOT NULL")
    if additive:
        usable = _described(usable, kernel)
    usable = materialised(usable.withColumn("pos", F.col("first")).drop("times", "prepared"))
    # `groups` are the classes that are left; strides in the whole numbering follow from all sizes.
    # A dataset that has lost a label has no product.
    sized = (
        library.sized_scaffolds(scaffolds, usable, kernel)
        .join(sizes, "dataset_id")
        .where(F.size("groups") == F.size("all_sizes"))
        .withColumn("strides", F.slice(library.strides(F.col("all_sizes")), 2, F.size("all_sizes")))
        .withColumn("_scaffold", kernel.prepare(F.col("smiles")))
        .where("_scaffold IS NOT NULL")
    )
    carried = ["strides"]
    if additive:
        sized, carried = _described(sized, kernel, "_scaffold"), ["strides", "values"]
    found = library.combinations(sized, library.fragment_blocks(usable, kernel), carried)
    first = F.aggregate(
        F.zip_with("fragments", "strides", lambda f, s: f["first"] * s), F.lit(0).cast("long"), lambda a, b: a + b
    )
    made = found.select(
        "dataset_id",
        "scaffold_id",
        first.alias("ord"),
        kernel.combine(F.col("_scaffold"), F.col("fragments.prepared")).alias("smiles"),
        F.map_from_arrays("labels", "fragments.smiles").alias("r_groups"),
        *(value.alias(c) for c, value in (_joined_values(kernel) if additive else {}).items()),
    ).where(F.col("smiles").isNotNull())
    if additive:
        made = made.withColumns({c: round_exact(F.col(c), DECIMALS) for c in kernel.descriptor_names})
    if separable and (additive or not describe):
        return made
    chosen = library.first_seen_distinct(made, ["dataset_id", "smiles"], ["scaffold_id", "ord"])
    # Written before it is described, so that Spark can't move the descriptors below the choice.
    return with_descriptors(materialised(chosen), kernel) if describe else chosen


def _all_sizes(fragments: DataFrame) -> DataFrame:
    counts = fragments.groupBy("dataset_id", "label").agg(F.sum("times").alias("n"))
    return counts.groupBy("dataset_id").agg(
        F.array_sort(F.collect_list(F.struct("label", "n"))).alias("all_sizes")
    )


def enumerate_library(
    scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel, max_products: int | None = None
) -> DataFrame:
    """Distinct products per dataset, each from the first scaffold and attempt that made it."""
    if max_products is not None:
        return library.capped_library(scaffolds, r_groups, kernel, max_products)
    return distinct_library(scaffolds, r_groups, kernel)


def described_library(
    scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel, max_products: int | None = None
) -> DataFrame:
    """The distinct products with the kernel's descriptors."""
    if max_products is not None:
        capped = library.capped_library(scaffolds, r_groups, kernel, max_products)
        return with_descriptors(materialised(capped), kernel)
    return distinct_library(scaffolds, r_groups, kernel, describe=True)


# --- Without rows -------------------------------------------------------------------------------


def _usable_scaffolds(scaffolds: DataFrame, fragments: DataFrame, kernel: Kernel) -> DataFrame:
    """Scaffold classes with as many attachment points as their dataset has labels."""
    labels = fragments.groupBy("dataset_id").agg(F.count_distinct("label").alias("n_labels"))
    return library.match_arity(scaffolds, labels, kernel).where("usable AND n_labels > 0")


def _parts(scaffolds: DataFrame, fragments: DataFrame, kernel: Kernel) -> DataFrame:
    """(dataset_id, no, times, prepared) of all classes: no 0 is the scaffolds, 1 and up the labels in order."""
    labels = fragments.select("dataset_id", "label").distinct().groupBy("dataset_id")
    labels = labels.agg(F.array_sort(F.collect_list("label")).alias("labels"))
    prepared = kernel.prepare(F.col("smiles")).alias("prepared")
    own = _usable_scaffolds(scaffolds, fragments, kernel).select("dataset_id", F.lit(0).alias("no"), "times", prepared)
    place = F.array_position("labels", F.col("label")).cast("int").alias("no")
    return own.unionByName(fragments.join(labels, "dataset_id").select("dataset_id", place, "times", prepared))


def _convolved(parts: DataFrame, columns: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Sums over all combinations, one row per dataset and total of marks.

    `parts` has (dataset_id, no, marks, n, *columns), one row for each dataset, part and marks; a column's
    two expressions say what it is for a combination of an `l` and an `r`, and what it is without an `r`.
    A step joins each dataset's few totals with the next label's few marks.
    """
    parts = materialised(parts)
    last = parts.agg(F.max("no")).first()[0] or 0
    state = parts.where("no = 0").drop("no")
    for no in range(1, last + 1):
        right = parts.where(F.col("no") == no).drop("no")
        joined = state.alias("l").join(right.alias("r"), F.col("l.dataset_id") == F.col("r.dataset_id"), "left")
        alone = F.col("r.dataset_id").isNull()
        made = joined.select(
            F.col("l.dataset_id").alias("dataset_id"),
            (F.col("l.marks") + F.coalesce("r.marks", F.lit(0))).alias("marks"),
            *(F.when(alone, without).otherwise(both).alias(c) for c, (both, without) in columns.items()),
        )
        state = materialised(made.groupBy("dataset_id", "marks").agg(*(F.sum(c).alias(c) for c in columns)))
    return state


def _counted(n: str = "n") -> tuple[Column, Column]:
    return (F.col(f"l.{n}") * F.col(f"r.{n}")).cast(COUNT), F.col(f"l.{n}")


def attempt_counts(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel) -> DataFrame:
    """``(dataset_id, attempted, valid, skipped)`` over all combinations of each dataset.

    With an additive kernel these are counts over marks; otherwise the attempts are made and counted.
    """
    if kernel.additive is None:
        return library.enumeration_stats(library.attempts(scaffolds, r_groups, kernel))
    parts = _parts(scaffold_classes(scaffolds), fragment_classes(r_groups), kernel)
    marks = F.coalesce(kernel.additive.marks(F.col("prepared")), F.lit(0)).cast("long")
    can = F.when(F.col("prepared").isNotNull(), F.col("times")).otherwise(0)
    by_marks = parts.groupBy("dataset_id", "no", marks.alias("marks")).agg(
        F.sum("times").cast(COUNT).alias("n"), F.sum(can).cast(COUNT).alias("can")
    )
    totals = _convolved(by_marks, {"n": _counted(), "can": _counted("can")})
    valid = F.sum(F.when(kernel.additive.possible(F.col("marks")), F.col("can")).otherwise(0))
    return (
        totals.groupBy("dataset_id")
        .agg(F.sum("n").cast("long").alias("attempted"), valid.cast("long").alias("valid"))
        .withColumn("skipped", F.col("attempted") - F.col("valid"))
    )


def product_moments(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel) -> DataFrame:
    """``dataset_id, n`` and for each descriptor its ``mean_`` and population deviation ``std_`` over the
    dataset's distinct products.

    With an additive kernel and separable parts no product is made: a part's values, less their mean in the
    dataset, are summed and squared by marks and convolved. Otherwise the described products are averaged.
    """
    names = list(kernel.descriptor_names)
    own, fragments = materialised(scaffold_classes(scaffolds)), materialised(fragment_classes(r_groups))
    if not _parts_are_separable(own, fragments, kernel):
        return distinct_library(scaffolds, r_groups, kernel, describe=True).groupBy("dataset_id").agg(
            F.count(F.lit(1)).alias("n"),
            *(F.avg(c).alias(f"mean_{c}") for c in names),
            *(F.stddev_pop(c).alias(f"std_{c}") for c in names),
        )
    parts = _parts(own, fragments, kernel).where("prepared IS NOT NULL")
    parts = materialised(_described(parts, kernel).select("dataset_id", "no", kernel.additive.marks(F.col("prepared")).alias("marks"), "values.*"))
    centres = parts.groupBy("dataset_id", "no").agg(*(F.avg(c).alias(f"c_{c}") for c in names))
    off = {c: F.col(c) - F.col(f"c_{c}") for c in names}
    by_marks = (
        parts.join(centres, ["dataset_id", "no"])
        .groupBy("dataset_id", "no", "marks")
        .agg(
            F.count(F.lit(1)).cast(COUNT).alias("n"),
            *(F.sum(off[c]).alias(f"s_{c}") for c in names),
            *(F.sum(off[c] * off[c]).alias(f"q_{c}") for c in names),
        )
    )
    columns = {"n": _counted()}
    n_l, n_r = (F.col(f"{side}.n").cast("double") for side in "lr")
    for c in names:
        s_l, s_r, q_l, q_r = (F.col(f"{side}.{kind}_{c}") for kind in "sq" for side in "lr")
        columns[f"s_{c}"] = (s_l * n_r + n_l * s_r, s_l)
        columns[f"q_{c}"] = (q_l * n_r + 2 * s_l * s_r + n_l * q_r, q_l)
    totals = _convolved(by_marks, columns).where(kernel.additive.possible(F.col("marks")))
    sums = totals.groupBy("dataset_id").agg(F.sum("n").cast("long").alias("n"), *(F.sum(c).alias(c) for c in columns if c != "n"))
    # The centres of the parts, and of the joints between them, come back to the mean.
    joints = F.max("no")
    back = centres.groupBy(F.col("dataset_id").alias("its")).agg(
        *((F.sum(f"c_{c}") + joints * F.lit(kernel.additive.joint.get(c, 0.0))).alias(f"c_{c}") for c in names)
    )
    mean = {c: F.col(f"s_{c}") / F.col("n") for c in names}
    spread = {c: F.sqrt(F.greatest(F.col(f"q_{c}") / F.col("n") - mean[c] * mean[c], F.lit(0.0))) for c in names}
    return sums.where("n > 0").join(back, F.col("dataset_id") == F.col("its")).select(
        "dataset_id",
        "n",
        *((F.col(f"c_{c}") + mean[c]).alias(f"mean_{c}") for c in names),
        *(spread[c].alias(f"std_{c}") for c in names),
    )


def product_counts(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel) -> DataFrame:
    """``(dataset_id, molecule_count)``: the distinct products of each dataset that has any."""
    return product_moments(scaffolds, r_groups, kernel).select("dataset_id", F.col("n").alias("molecule_count"))
