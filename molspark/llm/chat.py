"""Conversations from reply trees (operator 11).

Messages name the message they answer. Iterative self-joins of the (tree, id, parent) skeleton, whose
pointers reach twice as far each round, give every message its depth, its root and the sum of scores on
its way; so a chain of n answers takes log2(n) rounds, not n. Leaves are the ends of branches. Branches of
a tree are ranked by the mean score of their messages, and the chosen leaves are joined back down the
kept pointers, again by powers of two, to all messages on their paths. Only ids take part in all this.
Texts are shuffled once, by tree, beside the path rows they belong to. Trees of many messages (over a
ten-thousandth of all, so 10,000 at most, named by a broadcast list) are dealt by message first and by
path then, so that a tree's unchosen branches don't pile on one task.

The template marks turns with control strings. `<`, any number of backslashes and `|` get one more
backslash inside a text, so no text can hold a control string, and taking one off restores it.

A formatted conversation is one row, which holds one path.

Defined cases: null and empty texts are empty turns; a null role is empty; a null score is 0; a null or
unknown parent starts a tree's root, and a null id can't be answered; rows of equal tree and id are one
message in several rows, formatted one after the other (by role, then text), its parent the smallest
named; a null tree is a tree like others; messages that answer in a circle, and what hangs on them, reach no
root and stand in no conversation; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molspark.llm.common import arrow_schema, column, schema_of, text_pieces
from molspark.session import materialised

#: The template's control strings.
TURN, END = "<|im_start|>", "<|im_end|>\n"
LEARNT = "assistant"  # the role whose texts count in the loss
HOT_SHARE, HOT_LEAST = 10_000, 4_096  # a tree of more messages than total / share and than the least is hot


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role as one line."""
    lined = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(lined)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn.removeprefix(TURN).partition("\n")
        plain = re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescaped(role))
        out.append((plain, unescaped(text)))
    return out


def learnt_text(formatted: str, spans: list[tuple[int, int]]) -> str:
    """All text under the loss mask, unescaped."""
    return "".join(unescaped(formatted[start : start + length]) for start, length in spans)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _skeleton(nodes: DataFrame) -> DataFrame:
    """(tree, id, score, up) of each message; `up` is its parent if the tree has that, else null."""
    others = nodes.where("id IS NOT NULL").select(F.col("tree").alias("its"), F.col("id").alias("up"))
    joined = nodes.join(others, _same("tree", "its") & (F.col("parent") == F.col("up")), "left")
    return joined.select("tree", "id", F.coalesce("score", F.lit(0.0)).alias("score"), "up")


class Paths:
    """Depth, root and score of every message, and pointers to find the messages of a path."""

    def __init__(self, messages: DataFrame):
        nodes = materialised(
            messages.groupBy("tree", "id").agg(F.min("parent").alias("parent"), F.max("score").alias("score"))
        )
        longest = nodes.count()  # no way to a root has more steps
        # `up` is the ancestor `far` steps away, or null where there are fewer: `far` is then the depth.
        # `sum` is of the scores from the message on up to, but without, `up`.
        far = F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint")
        state = materialised(_skeleton(nodes).select("tree", "id", "up", far.alias("far"), F.col("score").alias("sum")))
        self.jumps: list[DataFrame] = []
        settled, active = [state.where("up IS NULL")], state.where("up IS NOT NULL")
        while (1 << len(self.jumps)) <= longest and not active.isEmpty():
            self.jumps.append(active.select("tree", "id", "up"))
            # Settled messages are only looked up; they take no part in further rounds themselves.
            above = reduce(DataFrame.unionByName, [*settled, active]).select(
                F.col("tree").alias("t"), F.col("id").alias("i"), F.col("up").alias("next"),
                F.col("far").alias("more"), F.col("sum").alias("above"),
            )
            moved = active.join(above, _same("tree", "t") & (F.col("up") == F.col("i")))
            state = materialised(
                moved.select(
                    "tree", "id", F.col("next").alias("up"), (F.col("far") + F.col("more")).alias("far"),
                    (F.col("sum") + F.col("above")).alias("sum"),
                )
            )
            settled, active = [*settled, state.where("up IS NULL")], state.where("up IS NOT NULL")
        # What is still active goes round in a circle.
        self.nodes = reduce(DataFrame.unionByName, settled).select("tree", "id", "far", "sum")
        self.parents = self.jumps[0].select("tree", "up") if self.jumps else state.select("tree", "up").limit(0)

    def leaves(self, branches: int | None) -> DataFrame:
        """(tree, leaf, rank, score, depth) of the best branches of every tree, by mean score, then id."""
        parents = self.parents.select(F.col("tree").alias("t"), F.col("up").alias("i")).distinct()
        ends = self.nodes.join(parents, _same("tree", "t") & (F.col("id") == F.col("i")), "left_anti")
        mean = F.col("sum") / (F.col("far") + 1)
        best = Window.partitionBy("tree").orderBy(mean.desc(), F.col("id").asc_nulls_last())
        ranked = ends.select("tree", F.col("id").alias("leaf"), F.row_number().over(best).alias("rank"), mean.alias("score"), F.col("far").alias("depth"))
        return ranked if branches is None else ranked.where(F.col("rank") <= branches)

    def members(self, leaves: DataFrame) -> DataFrame:
        """(tree, id, leaf, rank, score, depth) for every message on the paths to the leaves."""
        path = ["leaf", "rank", "score", "depth"]
        found = leaves.select("tree", F.col("leaf").alias("id"), *path)
        for k, jump in enumerate(self.jumps):
            # All ancestors fewer than 2^k steps away are there; those 2^k steps above them follow.
            step = jump.select(F.col("tree").alias("t"), F.col("id").alias("i"), "up")
            above = found.join(step, _same("tree", "t") & _same("id", "i")).select(
                "tree", F.col("up").alias("id"), *path[:-1], (F.col("depth") - F.lit(1 << k)).alias("depth")
            )
            found = materialised(found.unionByName(above))
        return found


TURNS = ["tree", "leaf", "rank", "score", "depth", "role", "text"]


def _beside(texts: DataFrame, members: DataFrame) -> DataFrame:
    """Text rows with the paths of their message: both kinds of rows are dealt by tree, sorted together.

    What is grouped by tree and path afterwards lies right already, so texts are shuffled once."""
    path = F.collect_list(F.struct("leaf", "rank", "score", "depth")).alias("paths")
    ways = members.groupBy("tree", "id").agg(path)
    none = lambda name: F.lit(None).cast(ways.schema[name].dataType if name in ways.columns else "string").alias(name)
    both = texts.select("tree", "id", none("paths"), "role", "text", F.lit(1).alias("kind")).unionByName(
        ways.select("tree", "id", "paths", none("role"), none("text"), F.lit(0).alias("kind"))
    )
    mine = Window.partitionBy("tree", "id").orderBy("kind").rowsBetween(Window.unboundedPreceding, 0)
    return (
        both.repartition("tree")
        .withColumn("paths", F.first("paths", ignorenulls=True).over(mine))
        .where("kind = 1")
        .select("tree", "role", "text", F.explode("paths").alias("p"))
        .select("tree", "p.leaf", "p.rank", "p.score", "p.depth", "role", "text")
    )


def _joined(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The same by a join on tree and message, for trees of very many messages."""
    ways = members.withColumnsRenamed({"tree": "t", "id": "i"})
    return texts.join(ways, _same("tree", "t") & _same("id", "i")).select(*TURNS)


def _formatted(turns: DataFrame) -> DataFrame:
    """One row for each path: its turns under the template, and the spans that are learnt."""
    head = F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n"))
    long = lambda text: F.char_length(text).cast("bigint")
    pieces = turns.withColumns(
        {"piece": F.concat(head, escaped(F.col("text")), F.lit(END)), "skip": long(head)}
    )
    so_far = Window.partitionBy("tree", "leaf").orderBy("depth", "role", "text")
    end = F.sum(long("piece")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    learnt = F.when(F.col("role") == LEARNT, long("piece") - F.col("skip") - len(END))
    placed = pieces.select(
        "tree", "leaf", "rank", "score", "piece", (end - long("piece")).alias("start"), "skip", learnt.alias("learnt")
    )
    # The group is one path, which is one row of the result.
    gathered = placed.groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"),
        F.first("score").alias("score"),
        F.count(F.lit(1)).alias("n_rows"),
        F.array_sort(F.collect_list(F.struct("start", "piece", "skip", "learnt"))).alias("m"),
    )
    spans = F.transform(
        F.filter("m", lambda t: t["learnt"].isNotNull()),
        lambda t: F.struct((t["start"] + t["skip"]).alias("start"), t["learnt"].alias("length")),
    )
    text = F.array_join(F.transform("m", lambda t: t["piece"]), "")
    return gathered.select("tree", "leaf", "rank", "score", "n_rows", text.alias("formatted"), spans.alias("loss"))


def _by_paths(skeleton: DataFrame, texts: DataFrame, branches: int | None) -> DataFrame:
    """Paths of `skeleton` (tree, id, parent, score) with the rows of `texts` (tree, id, role, text)."""
    paths = Paths(skeleton)
    members = paths.members(materialised(paths.leaves(branches)))
    sizes = materialised(texts.groupBy("tree").count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    many = sizes.where(F.col("count") > max(HOT_LEAST, total // HOT_SHARE)).select(F.col("tree").alias("hot"))
    if many.isEmpty():
        return _formatted(_beside(texts, members))
    hot = F.broadcast(many)  # HOT_SHARE rows at most: each stands for more than that part of all messages
    of_hot, of_others = (
        [rows.join(hot, _same("tree", "hot"), how) for rows in (texts, members)] for how in ("left_semi", "left_anti")
    )
    return _formatted(_beside(*of_others)).unionByName(_formatted(_joined(*of_hot)))


def _texts(rows: DataFrame, tree: str, id_col: str, role: str, text: str) -> DataFrame:
    blank = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias
    return rows.select(
        F.col(f"`{tree}`").alias("tree"), F.col(f"`{id_col}`").alias("id"), blank(role)("role"), blank(text)("text")
    )


def conversations(
    messages: DataFrame,
    tree_col: str = "conv_id",
    id_col: str = "id",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str = "score",
    branches: int | None = 1,
) -> DataFrame:
    """tree, leaf, rank, score, n_rows, formatted and loss of the best branches of each tree (None: all).

    `loss` holds the spans of `formatted`, in code points, whose text is learnt: the escaped texts of the
    assistant. A table without the score column has score 0 everywhere.
    """
    skeleton = messages.select(
        F.col(f"`{tree_col}`").alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{parent_col}`").cast(messages.schema[id_col].dataType).alias("parent"),
        column(messages, score_col, "double").alias("score"),
    )
    return _by_paths(skeleton, _texts(messages, tree_col, id_col, role_col, text_col), branches)


def plain_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The same for a table of plain conversations: each turn answers the one before it, so that a tree is
    one branch. Rows of equal turn stand one after the other; a null turn is the last."""
    turns = rows.select(F.col(f"`{conv_col}`").alias("tree"), F.col(f"`{turn_col}`").alias("id")).distinct()
    before = F.lag("id").over(Window.partitionBy("tree").orderBy(F.col("id").asc_nulls_last()))
    skeleton = turns.select("tree", "id", before.alias("parent"), F.lit(0.0).alias("score"))
    return _by_paths(skeleton, _texts(rows, conv_col, turn_col, role_col, text_col), 1)


READ = "tree bigint, n_turns bigint, turns string, loss_chars bigint, learnt string, formatted_chars bigint"


def read_back(made: DataFrame) -> DataFrame:
    """tree, n_turns, turns (role, text, each with a line feed), loss_chars, learnt text and formatted_chars,
    all read from the formatted conversations and their loss spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(READ)
        for batch in batches:
            for part in text_pieces(batch):
                rows = []
                for tree, formatted, loss in zip(*(c.to_pylist() for c in part.columns)):
                    turns, spans = turns_of(formatted), [(s["start"], s["length"]) for s in loss]
                    said = "".join(f"{role}\n{text}\n" for role, text in turns)
                    learnt = learnt_text(formatted, spans)
                    rows.append((tree, len(turns), said, len(learnt), learnt, len(formatted)))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return made.select(F.col("tree").cast("bigint"), F.col("formatted").alias("text"), "loss").mapInArrow(run, schema_of(READ))
