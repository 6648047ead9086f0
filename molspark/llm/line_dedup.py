"""Repeated passages of several lines (operator 1); Spark expressions only.

A text is cut into lines at line feeds; blank lines are passed over. Rolling hashes over windows of two
line hashes choose the boundaries of chunks: there is one wherever the window occurs nowhere else in the
table, so that chunk edges fall on the edges of shared passages whatever stands around them; and between
those one after each line whose window has the least hash of its neighbourhood, so that no chunk is a
line alone. Chunks of several lines are counted over the whole table by hash; of a chunk that occurs
more than once the first occurrence (smallest doc_id, then text hash, then line) stays, and the others
are removed after their bytes have been compared with the first.

Where a passage lies inside a longer shared run of another document, the chunks there have other edges.
So a repeated window that sticks out of the removed chunks is a chunk of two lines by itself, and single
lines of at least LONG_WORDS words are chunks too. As each window of a repeated chunk is repeated, the
result is simple to state: a line goes if it is long, or a neighbour of the next or last line of text,
and the same line or pair of lines stands earlier in the table. What goes still stands there, as the
earlier place can only have gone for a place earlier still.

Only line hashes are shuffled at first. Text is shuffled once for the documents that have something to
remove, and for the repeated chunks that are compared; work per text is linear in its lines.

Defined cases: null text counts as empty and stays null; line ends stay with the kept lines; blank lines
between two lines of a removed chunk go with it, others stay; rows of equal doc_id and text are one
document and get the same text; a null doc_id is larger than any other; a text all of whose lines are
removed becomes empty; an empty table gives no rows; other columns are carried along, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molspark.llm.common import id_and_text, unused
from molspark.session import materialised

LONG_WORDS = 50
MIN_LINES = 2
RUNS = "array<struct<first:int,last:int>>"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _full(line: Column) -> Column:
    return F.trim(line) != ""


def _documents(docs: DataFrame) -> DataFrame:
    """(doc_id, th, lines): per document the hash, word count and fullness of each line; no texts."""
    text = F.coalesce("text", F.lit(""))
    line = lambda x: F.struct(
        F.xxhash64(x).alias("h"), F.size(F.split(F.trim(x), r"[\x20\x09-\x0D]+")).alias("words"), _full(x).alias("full")
    )
    return docs.select("doc_id", F.xxhash64(text).alias("th"), F.transform(_lines(text), line).alias("lines")).dropDuplicates(
        ["doc_id", "th"]
    )


def _order(place: str) -> Column:
    """Which of two places comes first in the table."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th"), F.col(place).alias("first")
    )


def numbered_lines(docs: DataFrame) -> DataFrame:
    """(d, doc_id, th, pos, h, words, end, window, number): the lines of text. `window` is the hash of a line
    with the next one, at `end`, null where the pair occurs once; `number` is the chunk within document d."""
    listed = materialised(
        _documents(docs)
        .withColumn("d", F.monotonically_increasing_id())
        .select("d", "doc_id", "th", F.posexplode("lines").alias("pos", "line"))
        .where("line.full")
    )
    place = Window.partitionBy("d").orderBy("pos")
    rolled = materialised(
        listed.select("d", "doc_id", "th", "pos", "line.h", "line.words")
        .withColumn("next", F.lead("h").over(place))
        .withColumn("end", F.lead("pos").over(place))
        .withColumn("roll", F.when(F.col("next").isNotNull(), F.xxhash64("h", "next")))
        .drop("next")
    )
    # Windows that occur more than once; the hash alone is shuffled, after counting in each task.
    shared = (
        rolled.where("roll IS NOT NULL").groupBy("roll").agg(F.count("*").alias("n")).where("n > 1").select("roll")
    )
    linked = rolled.where("roll IS NOT NULL").join(shared, "roll").select("d", "pos", F.col("roll").alias("window"))
    # Null where the window isn't shared: a comparison with it is no cut.
    least = (F.col("window") < F.lag("window").over(place)) & (F.col("window") < F.lead("window").over(place))
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rolled.drop("roll")
        .join(linked, ["d", "pos"], "left")
        .withColumn("cut", (F.col("window").isNull() | F.coalesce(least, F.lit(False))).cast("int"))
        .withColumn("number", F.coalesce(F.sum("cut").over(before), F.lit(0)))
        # The chunk that holds both lines of the window, if one does.
        .withColumn("holder", F.when(F.col("cut") == 0, F.col("number")))
        .drop("cut")
    )


def _later(found: DataFrame) -> DataFrame:
    """The occurrences of repeated chunks, with whether each is the first."""
    repeated = (
        found.groupBy("chunk")
        .agg(F.count("*").alias("n"), F.min(_order("first")).alias("head"))
        .where("n > 1")
        .select("chunk", "head")
    )
    return found.join(repeated, "chunk").withColumn("is_first", _order("first") == F.col("head")).drop("head")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, th, first, last, chunk, is_first): the lines that repeated chunks take up; chunk is their hash."""
    lines = materialised(numbered_lines(docs))
    several = (
        lines.groupBy("d", "number")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("th").alias("th"),
            F.min("pos").alias("first"),
            F.max("pos").alias("last"),
            F.array_sort(F.collect_list(F.struct("pos", "h"))).alias("hs"),
        )
        .where(F.size("hs") >= MIN_LINES)
        .select("d", "number", "doc_id", "th", "first", "last", F.xxhash64(F.col("hs.h")).alias("chunk"))
    )
    long_lines = lines.where(F.col("words") >= LONG_WORDS).select(
        "d", F.lit(None).cast("bigint").alias("number"), "doc_id", "th",
        F.col("pos").alias("first"), F.col("pos").alias("last"), F.xxhash64(F.array("h")).alias("chunk"),
    )
    found = materialised(_later(materialised(several.unionByName(long_lines))))

    windows = lines.where("window IS NOT NULL").select(
        "d", "holder", "doc_id", "th", F.col("pos").alias("first"), F.col("end").alias("last"), F.col("window").alias("chunk")
    )
    taken = found.where("NOT is_first AND number IS NOT NULL").select("d", F.col("number").alias("holder"))
    repeated = materialised(_later(windows))
    out = materialised(repeated.where("NOT is_first").join(taken, ["d", "holder"], "left_anti"))
    # The first occurrences, to compare with; one row each, so the rest is met by at most one row.
    heads = repeated.where("is_first").join(out.select("chunk").distinct(), "chunk", "left_semi")
    columns = ["doc_id", "th", "first", "last", "chunk", "is_first"]
    return found.select(*columns).unionByName(out.select(*columns)).unionByName(heads.select(*columns))


def _with_lines(lines: Column, make: Callable[[Column], Column]) -> Column:
    """`make` of the lines, which are split once: they are bound to a variable, not written out in each use."""
    return F.transform(F.array(lines), make)[0]


def _part(lines: Column, first: Column, last: Column) -> Column:
    """The lines of text from first to last."""
    return F.array_join(F.filter(F.transform(F.sequence(first, last), lambda i: lines[i]), _full), "\n")


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed: str | None = None) -> DataFrame:
    """`docs` with repeated passages taken out of the text; `removed` names a column for the line runs,
    (first, last) each.

    Texts are shuffled once, to meet their runs; by sort-merge at any size, as the runs grow with the
    table. Only the text of repeated chunks is shuffled again, to be compared with the first's.
    """
    names = {c: unused(f"_{c}", docs) for c in ("id", "hash", "own", "runs")}
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`").cast("bigint")
    found = materialised(repeated_chunks(id_and_text(docs, id_col, text_col)))
    runs = (
        found.groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("first", "last", "chunk", "is_first")).alias(names["runs"]))
        .withColumnsRenamed({"doc_id": names["id"], "th": names["hash"]})
    )
    met = materialised(
        docs.withColumn(names["own"], F.xxhash64(_text(text))).join(
            runs.hint("merge"),
            doc_id.eqNullSafe(F.col(names["id"])) & (F.col(names["own"]) == F.col(names["hash"])),
            "left",
        ).drop(names["id"], names["hash"])
    )
    pieces = lambda lines: F.transform(
        names["runs"], lambda r: r.withField("part", _part(lines, r["first"], r["last"]).cast("binary"))
    )
    parts = (
        met.where(F.col(names["runs"]).isNotNull())
        .select(doc_id.alias("doc_id"), F.col(names["own"]).alias("th"), F.explode(_with_lines(_lines(_text(text)), pieces)).alias("r"))
        .select("doc_id", "th", "r.*")
    )
    heads = parts.where("is_first").groupBy("chunk").agg(F.min("part").alias("head"))
    # Chunks whose bytes aren't the first's, in spite of the same hash: hardly ever any.
    unlike = materialised(
        parts.where("NOT is_first").join(heads, "chunk").where("part <> head").select("doc_id", "th", "first", "last").distinct()
    )
    later = F.filter(names["runs"], lambda r: ~r["is_first"])
    gone = F.transform(later, lambda r: F.struct(r["first"].alias("first"), r["last"].alias("last")))
    if not unlike.isEmpty():
        spared = unlike.groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "last")).alias("spared"))
        spared = spared.select(F.col("doc_id").alias(names["id"]), F.col("th").alias(names["hash"]), F.col("spared").alias(unused("_spared", met)))
        met = met.join(spared, doc_id.eqNullSafe(F.col(names["id"])) & (F.col(names["own"]) == F.col(names["hash"])), "left")
        gone = F.array_except(gone, F.coalesce(F.col(spared.columns[2]), F.array().cast(RUNS)))
    gone = F.array_sort(F.coalesce(gone, F.array().cast(RUNS)))
    places = F.flatten(F.transform(gone, lambda r: F.sequence(r["first"], r["last"])))
    kept = lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: lines[i]
    )
    left = F.array_join(_with_lines(_lines(_text(text)), kept), "\n")
    cleaned = F.when(F.size(gone) > 0, left).otherwise(text)
    columns = [cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return met.select(*columns, *([gone.alias(removed)] if removed else []))
