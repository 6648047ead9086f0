"""SimHash near-duplicates by tiled exact comparison (operator 6).

Each text gets a fingerprint: one bit per position, set if it is set in over half of the XXH64 hashes
of the text's word shingles. Equal fingerprints form a class first. Classes are dealt into tiles by
their population counts; only tile pairs whose counts differ by no more than the radius can hold
links, and only those are compared, in blocks, with numpy exclusive-or and bit counts. A block pair
returns a star forest of its links, never the pairs themselves, which keeps every connection.
Components come from star contraction of those forests.

`drop_near_copies` keeps one document of each component. Only ids, hashes and fingerprints of texts are
shuffled for that; the documents themselves are read once more and lose those that go.

Defined cases: null text counts as empty; a text without words has fingerprint zero and links like
any other; a null doc_id takes part but is never the smallest of its component unless all are null;
repeated rows give repeated result rows; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import by_batch, id_and_text, raw, schema_of, unused, words
from molspark.llm.components import components
from molspark.session import materialised, shuffle_partitions

SEED = 42
BLOCK = 16_384  # fingerprints in a block at most, about
CELLS = 4_000_000  # comparisons held at once


def shingle_hashes(tokens: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of `size` words, space-joined; of the whole sequence if it is shorter."""
    if not tokens:
        return np.zeros(0, "<u8")
    flat, ends = b" ".join(tokens), list(itertools.accumulate(len(t) + 1 for t in tokens))
    hashed = xxhash.xxh64_intdigest
    if len(tokens) <= size:
        return np.array([hashed(flat, SEED)], "<u8")
    starts = [0, *ends[: len(tokens) - size]]
    return np.fromiter((hashed(flat[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :])), "<u8", len(starts))


def _more_bits(h: np.ndarray, lane: int) -> np.ndarray:
    """A further 64 bits for each hash: a mixing function of the hash and the lane."""
    if lane == 0:
        return h
    with np.errstate(over="ignore"):
        h = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(lane)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(hashes: np.ndarray, lanes: int) -> list[int]:
    """`lanes` signed 64-bit words; a bit is set if it is set in over half the hashes."""
    out = []
    for lane in range(lanes):
        set_in = np.zeros(64, np.int64)
        for part in range(0, len(hashes), 65_536):
            h = _more_bits(hashes[part : part + 65_536], lane)
            set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = (set_in * 2 > len(hashes)).astype(np.uint8)
        out.append(int(np.packbits(bits, bitorder="little").view("<i8")[0]))
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3, lanes: int = 1) -> DataFrame:
    """(doc_id, text_hash, fp) per row."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            fps = [fingerprint(shingle_hashes(words(text), shingle_words), lanes) for text in raw(batch, "text")]
            return {"doc_id": batch.column(0), "text_hash": batch.column(2), "fp": fps}

        return work

    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return by_batch(rows, "doc_id bigint, text_hash bigint, fp array<bigint>", make)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the same components as the links (a, b)."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least, new = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if np.array_equal(new, label):
            hung = label != np.arange(len(nodes))
            return nodes[hung], nodes[label[hung]]
        label = new


def _compare(left, left_ids, right, right_ids, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star forest of the links between two sets of fingerprints."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = max(1, CELLS // max(1, len(right)))
    for at in range(0, len(left), step):
        part = left[at : at + step]
        far = np.bitwise_count(part[:, None, 0] ^ right[None, :, 0]).astype(np.uint16)
        for lane in range(1, part.shape[1]):
            far += np.bitwise_count(part[:, None, lane] ^ right[None, :, lane])
        i, j = np.nonzero(far <= radius)
        x, y = left_ids[at : at + step][i], right_ids[j]
        apart = x != y
        if apart.any():
            a, b = stars(np.concatenate([a, x[apart]]), np.concatenate([b, y[apart]]))
    return a, b


def _forests(radius: int, lanes: int):
    def lists(batch, name):
        column = batch.column(batch.schema.get_field_index(name))
        return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            tile, sub = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("tile", "sub"))
            lo, ids = lists(batch, "left_ids")
            ro, other = lists(batch, "ids")
            _, fps = lists(batch, "left_fps")
            fo, right = lists(batch, "fps")
            fps, right = fps.view(np.uint64).reshape(-1, lanes), right.view(np.uint64).reshape(-1, lanes)
            # Neighbouring rows that meet the same block are compared in one go.
            edge = np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]) | (sub[1:] != sub[:-1]), True])
            for r0, r1 in itertools.pairwise(edge):
                mine, theirs = slice(lo[r0], lo[r1]), slice(ro[r0], ro[r0 + 1])
                a, b = _compare(fps[mine], ids[mine], right[fo[r0] // lanes : fo[r0 + 1] // lanes], other[theirs], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    return run


def _tile(lanes: int, radius: int, parts: int) -> tuple[Column, list[int]]:
    """The tile number of a fingerprint, and the steps to the tiles that may hold links.

    A tile is a vector of population counts: exact counts of `parts` equal parts of one word, or the
    whole count in steps of the radius. Of each pair of steps d and -d only one is listed.
    """
    if parts > 1:
        width = 64 // parts
        counts = [
            F.bit_count(F.shiftrightunsigned(F.col("fp")[0], width * i).bitwiseAND(F.lit((1 << width) - 1)))
            for i in range(parts)
        ]
        steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    else:
        whole = sum((F.bit_count(F.col("fp")[i]) for i in range(lanes)), F.lit(0))
        counts = [F.floor(whole / F.lit(max(1, radius))).cast("int")]
        steps = [(-1,), (0,), (1,)]
    key = F.lit(0).cast("bigint")
    for c in counts:
        key = key * 512 + c.cast("bigint")
    number = lambda s: sum(d * 512 ** (len(counts) - 1 - i) for i, d in enumerate(s))
    return key, sorted(number(s) for s in steps if s >= (0,) * len(s))


def linked_classes(rows: DataFrame, lanes: int, radius: int, parts: int = 1):
    """(classes, roots): classes has (cid, fp, doc_id), roots (node, root) of linked classes."""
    spark = rows.sparkSession
    classes = materialised(
        rows.groupBy("fp")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    tile, steps = _tile(lanes, radius, parts)
    tiled = classes.withColumn("tile", tile)
    # The vectors of population counts are few whatever the table holds, so this side is bounded.
    tiles = materialised(
        tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    )
    # Bounded: one number for each vector of counts (17 ** 4 at most), not for each text.
    dealt = tiled.join(F.broadcast(tiles), "tile").withColumn("sub", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    blocks = materialised(
        dealt.groupBy("tile", "sub")
        .agg(F.collect_list(F.struct("cid", "fp")).alias("m"))
        .select("tile", "sub", F.col("m.cid").alias("ids"), F.flatten("m.fp").alias("fps"))
    )
    own = F.col("own") == F.col("tile")
    left = (
        blocks.select(
            F.col("tile").alias("own"),
            F.col("sub").alias("own_sub"),
            F.col("ids").alias("left_ids"),
            F.col("fps").alias("left_fps"),
            F.explode(F.array(*(F.col("tile") + F.lit(s) for s in steps))).alias("tile"),
        )
        .join(F.broadcast(tiles), "tile")
        .withColumn("sub", F.explode(F.sequence(F.when(own, F.col("own_sub")).otherwise(F.lit(0)), F.col("blocks") - 1)))
        .select("tile", "sub", "left_ids", "left_fps")
    )
    tasks = shuffle_partitions(spark)
    met = left.repartition(tasks, "tile", "sub").join(blocks.repartition(tasks, "tile", "sub"), ["tile", "sub"])
    edges = met.mapInArrow(_forests(radius, lanes), schema_of("a bigint, b bigint"))
    return classes, components(edges)


def _with_component(rows: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row with the smallest doc_id that its fingerprint reaches."""
    joined = classes.join(roots, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    least = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = joined.select("fp", "root").join(least, "root").select("fp", "component_id", F.col("root").alias("component"))
    return rows.join(known, "fp")


def near_components(docs: DataFrame, shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id per row; fingerprints link at `radius` bits or fewer."""
    rows = materialised(fingerprints(docs, shingle_words).select("doc_id", "fp"))
    found = _with_component(rows, *linked_classes(rows, 1, radius, parts=4))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 3
) -> DataFrame:
    """One row of each component of near copies, with the columns of `docs`.

    The row of the smallest doc_id stays (null last, then the smallest hash of the text). Rows of equal
    doc_id and text are one document.
    """
    rows = materialised(fingerprints(id_and_text(docs, id_col, text_col), shingle_words))
    found = _with_component(rows, *linked_classes(rows, 1, radius, parts=4))
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    documents = found.select("component", one.alias("one")).groupBy("component", "one").agg(F.count(F.lit(1)).alias("times"))
    first = documents.groupBy(F.col("component").alias("its")).agg(F.min("one").alias("first"))
    key, hashed = unused("_key", docs), unused("_hash", docs)
    # What goes, and what stays but is there more than once: far fewer rows than the table has.
    marked = materialised(
        documents.join(first, F.col("component") == F.col("its"))
        .withColumn("stays", F.col("one") == F.col("first"))
        .where("NOT stays OR times > 1")
        .select(F.col("one.doc_id").alias(key), F.col("one.text_hash").alias(hashed), "stays")
    )
    other = unused("_other", docs)
    own = docs.withColumn(other, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    same = F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(key)) & (F.col(other) == F.col(hashed))
    repeated = own.join(marked.where("stays"), same).dropDuplicates([key, hashed])
    left = own.join(marked, same, "left_anti")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return left.select(*names).unionByName(repeated.select(*names))
