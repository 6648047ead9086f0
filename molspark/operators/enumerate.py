"""Enumeration of every scaffold with every combination of fragments.

Tables: ``scaffolds(dataset_id, scaffold_id, smiles)`` and the long fragment table
``r_groups(dataset_id, label, pos, smiles)``, where ``pos`` numbers the source rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.functions.columns import strip
from molspark.functions.kernel import Kernel
from molspark.functions.ordering import dense_index, sorted_position
from molspark.session import shuffle_partitions

ATTEMPTS_PER_CHUNK = 4096
CHUNKS_PER_STEP = 4096
FRAGMENTS_PER_BLOCK = 1024
SCAFFOLDS_PER_CREW = 16
# A scaffold's combinations are numbered by a long.
MOST_ATTEMPTS = float(1 << 63)


def trimmed(cell: Column | str) -> Column:
    """Null becomes blank; all outer white space goes, not only spaces."""
    text = F.coalesce(F.col(cell) if isinstance(cell, str) else cell, F.lit(""))
    return strip(text)


def load_r_groups(
    wide: DataFrame, labels: Sequence[str], kernel: Kernel, keys: Sequence[str] = ("dataset_id",)
) -> DataFrame:
    """Wide fragment rows to the long table, keeping only rows in which every cell is usable.

    `wide` has `keys`, ``pos`` and one column per label.
    """
    clean = wide.select(*keys, "pos", *(trimmed(c).alias(c) for c in labels))
    usable = reduce(and_, ((F.col(c) != "") & kernel.is_valid(F.col(c)) for c in labels))
    # The flag travels through the generated rows: a filter below would be merged with the
    # trimming and repeat it for every use of a cell.
    flagged = clean.withColumn("_usable", usable)
    cells = [
        F.struct(F.lit(c).alias("label"), F.col(c).alias("smiles"), F.col("_usable").alias("_ok"))
        for c in labels
    ]
    return flagged.select(*keys, "pos", F.inline(F.array(*cells))).where("_ok").drop("_ok")


def load_r_group_cells(cells: DataFrame, kernel: Kernel) -> DataFrame:
    """The same rule for cells already in long form ``(dataset_id, label, pos, smiles)``.

    Datasets with different columns then share one table. A source row is a few cells, so the
    window groups are small.
    """
    cell = trimmed("smiles")
    clean = cells.withColumn("smiles", cell).withColumn(
        "_usable", (cell != "") & kernel.is_valid(cell)
    )
    rows = clean.groupBy("dataset_id", "pos").agg(F.bool_and("_usable").alias("_row_usable"))
    return (
        clean.join(rows.where("_row_usable"), ["dataset_id", "pos"])
        .drop("_usable", "_row_usable")
    )


def indexed_r_groups(r_groups: DataFrame) -> DataFrame:
    """Replace source positions by the 0-based index of each fragment under its label."""
    return dense_index(r_groups, "pos", ["dataset_id", "label"], "idx").drop("pos")


def label_sizes(r_groups: DataFrame) -> DataFrame:
    """One row per dataset: its labels in lexical order, each with its number of fragments."""
    counts = r_groups.groupBy("dataset_id", "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("dataset_id").agg(
        F.array_sort(F.collect_list(F.struct("label", "n"))).alias("groups")
    )


def fragment_blocks(r_groups: DataFrame, kernel: Kernel) -> DataFrame:
    """The prepared fragments of each label in blocks of at most FRAGMENTS_PER_BLOCK; further columns
    of the fragments come along."""
    more = [c for c in r_groups.columns if c not in ("dataset_id", "label", "pos", "smiles")]
    return (
        indexed_r_groups(r_groups)
        .withColumn("prepared", kernel.prepare(F.col("smiles")))
        .withColumn("block", _div(F.col("idx"), F.lit(FRAGMENTS_PER_BLOCK)))
        .groupBy("dataset_id", "label", "block")
        .agg(F.collect_list(F.struct("idx", "smiles", "prepared", *more)).alias("fragments"))
    )


def _div(a: Column, b: Column) -> Column:
    """Whole division of longs, without going through doubles."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def match_arity(scaffolds: DataFrame, label_counts: DataFrame, kernel: Kernel) -> DataFrame:
    """Scaffolds with ``n_points``, ``n_labels`` and whether enumeration can use them."""
    smiles = trimmed("smiles")
    return (
        scaffolds.withColumn("smiles", smiles)
        .where(F.col("smiles") != "")
        .join(label_counts, "dataset_id", "left")
        .withColumn("n_labels", F.coalesce("n_labels", F.lit(0)).cast("int"))
        .withColumn("n_points", kernel.n_points(F.col("smiles")))
        .withColumn(
            "usable",
            kernel.is_valid(F.col("smiles")) & (F.col("n_points") == F.col("n_labels")),
        )
    )


def strides(groups: Column, max_products: int | None = None) -> Column:
    """Per label, how many attempts pass before its digit moves; the last label moves fastest. The
    number of attempts comes first.

    With a cap, products are cut at it as they grow; without one, more combinations than a long can
    number raise an error.
    """

    def product(value: Column, n: Column) -> Column:
        if max_products is not None:
            cap = F.lit(max_products).cast("long")
            return F.least(cap, value * F.least(cap, n))
        too_many = value.cast("double") * n.cast("double") >= MOST_ATTEMPTS
        message = F.lit("A scaffold has more fragment combinations than a long can number; give max_products.")
        return F.when(too_many, F.raise_error(message).cast("long")).otherwise(
            value * F.when(too_many, F.lit(0)).otherwise(n)
        )

    return F.reverse(
        F.aggregate(
            F.reverse(groups),
            F.struct(F.array().cast("array<bigint>").alias("strides"), F.lit(1).cast("long").alias("next")),
            lambda acc, g: F.struct(
                F.array_append(acc["strides"], acc["next"]).alias("strides"),
                product(acc["next"], g["n"]).alias("next"),
            ),
            lambda acc: F.array_append(acc["strides"], acc["next"]),
        )
    )


def _digit_value(digit: Column, attempt: Column) -> Column:
    """The fragment that attempt number `attempt` takes for one label."""
    step = _div(attempt, digit["stride"]) - digit["base"]
    return F.get(digit["fragments"], (step % F.size(digit["fragments"])).cast("int"))


def _digits(parts: Column) -> Column:
    """Per label in order, its fragments in order of use, from the parts of its blocks."""

    def digit(no: Column) -> Column:
        own = F.filter(parts, lambda p: p["no"] == no)
        first = F.get(own, F.lit(0))
        fragments = F.array_sort(F.flatten(F.transform(own, lambda p: p["used"])))
        return F.struct(
            first["label"].alias("label"),
            first["base"].alias("base"),
            first["stride"].alias("stride"),
            fragments.alias("fragments"),
        )

    last = F.array_max(F.transform(parts, lambda p: p["no"]))
    return F.transform(F.sequence(F.lit(0), last), digit)


def sized_scaffolds(
    scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel, max_products: int | None = None
) -> DataFrame:
    """Usable scaffolds with their labels, strides and number of attempts (``_total``)."""
    sizes = label_sizes(r_groups).select("dataset_id", F.size("groups").alias("n_labels"), "groups")
    return (
        match_arity(scaffolds, sizes, kernel)
        .where("usable AND groups IS NOT NULL")
        .withColumn("_strides", strides(F.col("groups"), max_products))
        .withColumn("_total", F.element_at("_strides", 1))
        .withColumn("_strides", F.slice("_strides", 2, F.size("groups")))
    )


def _crews(sized: DataFrame, whole: Sequence[str]) -> DataFrame:
    """Scaffolds of a dataset in crews of at most SCAFFOLDS_PER_CREW: a crew uses the same fragments.

    ``_times`` is how often the ids of the crew occur; ids should occur once.
    """
    of_dataset = ["groups", "_strides", "_total"]
    once = sized.groupBy("dataset_id", "scaffold_id").agg(
        F.count(F.lit(1)).cast("int").alias("_times"), *(F.first(c).alias(c) for c in [*of_dataset, *whole])
    )
    placed = sorted_position(once, ["dataset_id", "_times", "scaffold_id"], "_at")
    return placed.groupBy("dataset_id", "_times", _div(F.col("_at"), F.lit(SCAFFOLDS_PER_CREW)).alias("crew")).agg(
        *(F.first(c).alias(c) for c in of_dataset),
        F.collect_list(F.struct("scaffold_id", *whole)).alias("_crew"),
    )


def _chunks(sized: DataFrame, whole: Sequence[str]) -> DataFrame:
    """A row per chunk of attempts and label: which of the label's fragments the chunk uses.

    Attempts _first.._last use fragments a, a + 1, ... (`take` of them, round the end of the list).
    """
    step = F.lit(ATTEMPTS_PER_CHUNK * CHUNKS_PER_STEP).cast("long")
    chunk = F.lit(ATTEMPTS_PER_CHUNK).cast("long")
    low = _div(F.col("_first"), F.col("stride"))
    ranged = (
        sized.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_total") - 1, step)))
        .withColumn(
            "_first", F.explode(F.sequence("_from", F.least(F.col("_from") + step, F.col("_total")) - 1, chunk))
        )
        .withColumn("_last", F.least(F.col("_first") + chunk, F.col("_total")) - 1)
        .select(
            "dataset_id",
            *whole,
            "_first",
            "_last",
            F.posexplode(
                F.zip_with("groups", "_strides", lambda g, s: F.struct(g["label"].alias("label"), g["n"].alias("n"), s.alias("stride")))
            ).alias("no", "g"),
        )
        .select("dataset_id", *whole, "_first", "_last", "no", "g.*")
        .withColumn("base", low)
        .withColumn("a", F.col("base") % F.col("n"))
        .withColumn("take", F.least(_div(F.col("_last"), F.col("stride")) - F.col("base") + 1, F.col("n")))
    )
    size = F.lit(FRAGMENTS_PER_BLOCK)
    stop = F.col("a") + F.col("take") - 1
    blocks = F.sequence(_div(F.col("a"), size), _div(F.least(stop, F.col("n") - 1), size))
    round_the_end = F.sequence(F.lit(0).cast("long"), _div(stop - F.col("n"), size))
    return ranged.withColumn(
        "block",
        F.explode(F.when(stop < F.col("n"), blocks).otherwise(F.array_union(blocks, round_the_end))),
    )


def combinations(
    sized: DataFrame,
    blocks: DataFrame,
    carried: Sequence[str] = (),
    made: Callable[[Column, Column], Sequence[Column]] = lambda labels, fragments: [labels.alias("labels"), fragments.alias("fragments")],
) -> DataFrame:
    """Every combination: ``dataset_id, scaffold_id, _scaffold``, the `carried` columns of the scaffold,
    ``ord`` and what is `made` of the labels and of the entries of the fragment blocks in label order, by
    default the columns ``labels`` and ``fragments``.

    Combination number `ord` is decoded digit by digit into one fragment per label. Combinations are
    produced in chunks of bounded size. A chunk meets only the fragment blocks it uses, and of those only
    the fragments it uses go on; so no row ever holds all fragments of a dataset. Chunk number j has the same
    fragments for every scaffold of a dataset, so they travel and are decoded once for a crew of scaffolds.
    """
    keys = ["dataset_id", "_times", "crew", "_first"]
    at = lambda f: F.pmod(f["idx"] - F.col("a"), F.col("n"))
    entry = [f.name for f in blocks.schema["fragments"].dataType.elementType if f.name != "idx"]
    used = F.transform(
        F.filter("fragments", lambda f: at(f) < F.col("take")),
        lambda f: F.struct(at(f).alias("at"), *(f[c].alias(c) for c in entry)),
    )
    whole = ["_scaffold", *carried]
    crews = _crews(sized, whole)
    chunks = (
        _chunks(crews, ["_times", "crew", "_crew"])
        .join(blocks, ["dataset_id", "label", "block"])
        .select(*keys, "_crew", "_last", F.struct("no", "label", "base", "stride", used.alias("used")).alias("part"))
        # A stated number of partitions: a chunk is small but its work is not, so the chunks must
        # not be packed together by their size.
        .repartition(shuffle_partitions(sized.sparkSession), *keys)
        .groupBy(*keys)
        .agg(
            F.first("_crew").alias("_crew"),
            F.first("_last").alias("_last"),
            F.collect_list("part").alias("_parts"),
        )
        .withColumn("_digits", _digits(F.flatten(F.array_repeat("_parts", F.col("_times")))))
    )
    decoded = F.transform(
        F.sequence("_first", "_last"),
        lambda o: F.struct(o.alias("ord"), F.transform("_digits", lambda d: _digit_value(d, o)).alias("fragments")),
    )
    ready = chunks.select("dataset_id", "_crew", F.col("_digits.label").alias("labels"), decoded.alias("_decoded")).select(
        "dataset_id",
        "_crew",
        F.transform("_decoded", lambda d: F.struct(d["ord"].alias("ord"), *made(F.col("labels"), d["fragments"]))).alias("_made"),
    )
    # Decoding happens before the rows are exploded, so no product row ever drags the chunk's
    # fragment arrays along. Neither array is ever empty or null; from a plain `inline` Spark would infer a
    # filter on that, which decodes everything a second time.
    return ready.select("dataset_id", F.inline_outer("_crew"), "_made").select(
        "dataset_id", "scaffold_id", *whole, F.inline_outer("_made")
    )


def attempts(
    scaffolds: DataFrame,
    r_groups: DataFrame,
    kernel: Kernel,
    max_products: int | None = None,
) -> DataFrame:
    """Every attempt: ``dataset_id, scaffold_id, ord, smiles, r_groups``; null smiles = skipped.

    `r_groups` maps each label to its fragment; scaffold ids are unique in their dataset. All
    combinations are attempted, or the first `max_products` of each scaffold if the caller says so.
    """
    sized = sized_scaffolds(scaffolds, r_groups, kernel, max_products).withColumn(
        "_scaffold", kernel.prepare(F.col("smiles"))
    )

    def made(labels: Column, fragments: Column) -> list[Column]:
        return [
            fragments["prepared"].alias("_prepared"),
            F.exists(fragments, lambda f: f["prepared"].isNull()).alias("_unprepared"),
            F.map_from_arrays(labels, fragments["smiles"]).alias("r_groups"),
        ]

    decoded = combinations(sized, fragment_blocks(r_groups, kernel), made=made)
    prepared_ok = F.col("_scaffold").isNotNull() & ~F.col("_unprepared")
    return decoded.select(
        "dataset_id",
        "scaffold_id",
        "ord",
        F.when(prepared_ok, kernel.combine(F.col("_scaffold"), F.col("_prepared"))).alias("smiles"),
        "r_groups",
    )


def first_seen_distinct(
    products: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per `keys`: the one with the least `order` (a total order).

    ``min_by`` combines on the map side, so a product repeated in a third of all rows reaches the
    reducer once per task.
    """
    rest = [c for c in products.columns if c not in keys]
    picked = products.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    )
    return picked.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in rest))


def capped_library(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel, max_products: int) -> DataFrame:
    """Distinct products per dataset among the first `max_products` attempts of each scaffold, each from
    the first scaffold and attempt that made it."""
    made = attempts(scaffolds, r_groups, kernel, max_products).where(F.col("smiles").isNotNull())
    return first_seen_distinct(made, ["dataset_id", "smiles"], ["scaffold_id", "ord"])


def enumeration_stats(made: DataFrame, possible: DataFrame | None = None) -> DataFrame:
    """Attempted, valid and skipped combinations per dataset; with `possible_counts`, how many there
    are in all, so that a cap shows."""
    stats = made.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count("smiles").alias("valid"),
        (F.count(F.lit(1)) - F.count("smiles")).alias("skipped"),
    )
    return stats if possible is None else stats.join(possible, "dataset_id")


def possible_counts(scaffolds: DataFrame, r_groups: DataFrame, kernel: Kernel) -> DataFrame:
    """``(dataset_id, possible)``: all combinations of its usable scaffolds."""
    return sized_scaffolds(scaffolds, r_groups, kernel).groupBy("dataset_id").agg(F.sum("_total").alias("possible"))


def wide_products(products: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Map entries to columns, for export. A label named ``smiles`` replaces the product."""
    kept = [c for c in products.columns if c != "r_groups" and c not in labels]
    return products.select(*kept, *(F.col("r_groups")[c].alias(c) for c in labels))
