"""A forest of sorted MinHash prefixes that is written once and answers batches of queries.

The index is three tables in a folder: `nodes` (one row per distinct fingerprint), `leaves` (the ids of
all nodes in each tree, in the order of dataset, tree, prefix and id, as blocks of positions) and `runs` (for every
prefix length the first and last position that share the prefix). It is built some trees at a time, and queries
are compared some at a time, so that only a part of the leaves and candidates is on the disk at once. A batch of queries descends from
long to short prefixes by equal joins with `runs`: each query stops at the longest length at which its
trees offer enough leaves. It then takes at most `per_tree` positions of each tree, around the longest
run that it shares, so a prefix held by a third of all rows costs a query no more than any other.
Candidates are compared exactly.

A folder written by a failed build has no `nodes`, which are written last, and cannot be opened.

Defined cases: copies of a fingerprint are one node under their least id, listed in `copies`; a node or
query without a fingerprint, or with an empty one, is in no result; a query whose prefixes nobody shares
in any tree has no rows; a query that is in the index finds itself; equal distances rank by id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molspark.functions.kernel import FINGERPRINT_BITS
from molspark.functions.ordering import sorted_position
from molspark.operators.similarity import DEPTH, KEY, NEIGHBOURS, TREES, collapse_copies, distance_of_sized, sized_sets, tree_prefixes
from molspark.session import discard, materialised, work_scope

# Leaves of each tree that a query takes at most, and leaves of all trees that let it stop.
PER_TREE = 128
ENOUGH = 8192
# Positions in a block of leaves; leaves that are sorted at once, and parts of the trees at most; queries compared at once.
BLOCK = 1024
LEAVES_AT_ONCE, TREE_SLICES = 4_000_000, 32
QUERIES_AT_ONCE = 2048


@dataclass(frozen=True)
class ForestIndex:
    nodes: DataFrame
    copies: DataFrame
    leaves: DataFrame
    runs: DataFrame
    trees: int
    depth: int


def _by_length(df: DataFrame, depth: int) -> DataFrame:
    """Each row once per prefix length, with the prefix cut to it; the length is the size of `prefix`."""
    cut = F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda n: F.slice("prefix", F.lit(1), n))
    return df.withColumn("_cut", F.explode(cut)).drop("prefix").withColumnRenamed("_cut", "prefix")


def build(nodes: DataFrame, path: str, trees: int = TREES, depth: int = DEPTH) -> ForestIndex:
    """Index ``(dataset_id, id, fingerprint)`` in the folder `path`, which must not hold an index yet."""
    # What the index is made from is not needed once it is written.
    with work_scope(nodes.sparkSession):
        usable = nodes.select(KEY, "id", "fingerprint").where(F.size("fingerprint") > 0)
        distinct, copies = collapse_copies(usable)
        size = distinct.count()
        count = max(1, min(TREE_SLICES, trees, -(-size * trees // LEAVES_AT_ONCE)))
        cuts = [trees * i // count for i in range(count + 1)]
        first = 0
        for a, b in zip(cuts, cuts[1:]):
            with work_scope(nodes.sparkSession):
                _write_trees(tree_prefixes(distinct, b - a, depth, a), depth, first, path)
            # A block holds leaves of one part only.
            first += -(-size * (b - a) // BLOCK) * BLOCK
        copies.select(KEY, F.col("src").alias("id"), F.col("dst").alias("copy")).write.parquet(f"{path}/copies")
        distinct.withColumns({"trees": F.lit(trees), "depth": F.lit(depth)}).write.parquet(f"{path}/nodes")
    return open_index(nodes.sparkSession, path)


def _write_trees(leaves: DataFrame, depth: int, first: int, path: str) -> None:
    """Add the leaves of some trees, and their runs, to the index; their positions begin at `first`."""
    placed = sorted_position(leaves, [KEY, "tree", "prefix", "id"])
    placed = materialised(placed.withColumn("pos", F.col("pos") + first))
    blocks = placed.groupBy(F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_l"))
    blocks.select("block", F.col("_l.id").alias("ids")).write.mode("append").parquet(f"{path}/leaves")
    # Least and greatest are combined in each task first, so the hot prefixes of length 1 do no harm.
    runs = (
        _by_length(placed.select(KEY, "tree", "prefix", "pos"), depth)
        .groupBy(KEY, "tree", "prefix")
        .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    )
    runs.write.mode("append").parquet(f"{path}/runs")


def open_index(spark: SparkSession, path: str) -> ForestIndex:
    """The index in the folder `path`; it has the shape that it was built with."""
    nodes, copies, leaves, runs = (spark.read.parquet(f"{path}/{t}") for t in ("nodes", "copies", "leaves", "runs"))
    shape = nodes.select("trees", "depth").head() or (TREES, DEPTH)
    return ForestIndex(nodes.drop("trees", "depth"), copies, leaves, runs, *shape)


def candidates(index: ForestIndex, queries: DataFrame, enough: int = ENOUGH, per_tree: int = PER_TREE) -> DataFrame:
    """``(dataset_id, src, dst)``: the nodes (dst) that each query (src) is to be compared with."""
    return _in_ranges(index, _ranges(index, queries, enough, per_tree))


def _ranges(index: ForestIndex, queries: DataFrame, enough: int, per_tree: int) -> DataFrame:
    """``(dataset_id, src, start, stop)``: the positions that a query takes, at most one range in a tree."""
    # The planner sees files of few bytes, not the rows that are exploded from them, and would broadcast these.
    asked = tree_prefixes(queries, index.trees, index.depth).withColumn("last", F.element_at("prefix", -1))
    met = materialised(
        _by_length(asked, index.depth)
        .join(index.runs.hint("merge"), [KEY, "tree", "prefix"])
        .select(KEY, "id", "tree", F.size("prefix").alias("length"), "last", "lo", "hi")
    )
    offers = met.groupBy(KEY, "id", "length").agg(F.sum(F.least(F.col("hi") - F.col("lo") + 1, F.lit(per_tree))).alias("n"))
    # The longest length that offers enough; the shortest one shared where none does.
    stops = offers.groupBy(KEY, "id").agg(
        F.coalesce(F.max(F.when(F.col("n") >= enough, F.col("length"))), F.min("length")).alias("stop")
    )
    # A query has one row per tree and length here, so these groups are small.
    deepest = Window.partitionBy(KEY, "id", "tree")
    chosen = (
        met.join(stops.hint("merge"), [KEY, "id"])
        .withColumn("_deep", F.max(F.struct("length", "lo", "hi")).over(deepest))
        .where(F.col("length") == F.col("stop"))
    )
    # Where no longer run tells the place inside a long run, the query's last hash picks one.
    size = F.col("hi") - F.col("lo") + 1
    place = F.when(F.col("_deep.length") > F.col("length"), F.col("_deep.lo")).otherwise(F.col("lo") + F.col("last") % size)
    start = F.greatest(F.col("lo"), F.least(place - per_tree // 2, F.col("hi") - per_tree + 1))
    return chosen.select(
        KEY, F.col("id").alias("src"), start.alias("start"), F.least(start + per_tree - 1, "hi").alias("stop")
    )


def _in_ranges(index: ForestIndex, ranges: DataFrame) -> DataFrame:
    """``(dataset_id, src, dst)``: the nodes in the ranges of each query, once."""

    def block(pos: str) -> Column:
        return F.floor(F.col(pos) / BLOCK)

    pieces = ranges.withColumn("block", F.explode(F.sequence(block("start"), block("stop"))))
    low, high = F.greatest("start", F.col("block") * BLOCK), F.least("stop", F.col("block") * BLOCK + BLOCK - 1)
    met = pieces.join(index.leaves.hint("merge"), "block").select(
        KEY, "src", F.slice("ids", (low % BLOCK + 1).cast("int"), (high - low + 1).cast("int")).alias("ids")
    )
    # At most `per_tree` ids of a tree come together, so these lists are bounded.
    each = met.groupBy(KEY, "src").agg(F.collect_list("ids").alias("ids"))
    return each.select(KEY, "src", F.explode(F.array_distinct(F.flatten("ids"))).alias("dst"))


def nearest(
    index: ForestIndex,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    enough: int = ENOUGH,
    per_tree: int = PER_TREE,
    bits: int | None = FINGERPRINT_BITS,
) -> DataFrame:
    """``(dataset_id, id, neighbour, dist, rank)``: the k nearest nodes found for each query
    ``(dataset_id, id, fingerprint)``; query ids are unique within a dataset."""
    asked = materialised(queries.select(KEY, "id", "fingerprint").where(F.size("fingerprint") > 0))
    ranges = materialised(_ranges(index, asked, enough, per_tree))
    targets, own = sized_sets(index.nodes, bits), sized_sets(asked, bits)
    count = max(1, -(-asked.count() // QUERIES_AT_ONCE))
    order = Window.partitionBy(KEY, "src").orderBy("dist", "dst")
    found = []
    for i in range(count):

        def part(rows: DataFrame, name: str) -> DataFrame:
            return rows.where(F.pmod(F.xxhash64(KEY, name), F.lit(count)) == i)

        with work_scope(asked.sparkSession):
            pairs = _in_ranges(index, part(ranges, "src"))
            dist = distance_of_sized(pairs, part(own, "id"), targets, bits, few=True)
            near = dist.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            found.append(materialised(near.select(KEY, F.col("src").alias("id"), F.col("dst").alias("neighbour"), "dist", "rank"), outer=True))
    for table in (asked, ranges, targets, own):
        discard(table)
    return reduce(DataFrame.unionByName, found)
