"""Benchmark passages inside documents (operator 5).

Items are partitioned by their number of distinct word shingles. An item's sketch is its bottom-k
MinHash: the k shingles of smallest hash. A document holding at least `containment` of n shingles
misses at most n - ceil(containment x n) of them, so k = that number + 1, taken for the largest n of
the size partition, makes it sure that a sketch of every contained item is met: the search loses
nothing. What the sketches find is verified by exact containment of the shingles themselves.

Items come in blocks of bounded size, each broadcast to one pass over the whole documents. A
document's words are looked up once; only runs of words that some item of the block uses are hashed.

Defined cases: null texts count as empty; an item without words is in no document; an item shorter
than a shingle is one shingle, looked for among runs of as many words; null ids are kept as null;
repeated documents or items give repeated rows; empty tables give no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import by_batch, id_and_text, raw, words

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_BYTES = 16_000_000  # benchmark text in one broadcast block, about
FOUND = "doc_id bigint, item_id bigint, shared int, shingles int, containment double"


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _runs(numbers: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` word numbers; zero, which is no word of the block, spoils a run."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for i in range(size):
            part = numbers[i : i + n]
            whole &= part != 0
            h = h * np.uint64(0x100000001B3) + part
    h = _mixed(h + np.uint64(size))
    h[~whole] = 0
    return h


def largest_of_class(n: int) -> int:
    """The largest shingle count of the size partition that holds n: partitions double in quarters."""
    return n if n <= 4 else math.ceil(2 ** (math.ceil(math.log2(n) * 4) / 4))


class Index:
    """The sketches of a block of items, by shingle length."""

    def __init__(self, items: list[tuple[int | None, bytes]], shingle: int, containment: float):
        self.shingle, self.containment = shingle, containment
        self.number: dict[bytes, int] = {}
        self.items: list[tuple[int | None, int, np.ndarray, frozenset[bytes]]] = []
        postings: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            tokens = words(text)
            if not tokens:
                continue
            size = min(shingle, len(tokens))
            numbers = np.array([self.number.setdefault(t, len(self.number) + 1) for t in tokens], np.uint64)
            spelt = frozenset(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))
            hashes = np.unique(_runs(numbers, size))
            most = max(largest_of_class(len(hashes)), len(hashes))
            for h in hashes[: most - math.ceil(containment * most - 1e-9) + 1]:
                postings[size][int(h)].append(len(self.items))
            self.items.append((item_id, size, hashes, spelt))
        self.sketch = {
            size: (np.array(sorted(p), np.uint64), [p[h] for h in sorted(p)]) for size, p in postings.items()
        }

    def search(self, text: bytes | None) -> list[tuple[int | None, int, int]]:
        """(item_id, shared shingles, shingles) of the items that the text holds."""
        tokens = words(text)
        if not tokens or not self.items:
            return []
        get = self.number.get
        numbers = np.fromiter((get(t, 0) for t in tokens), np.uint64, len(tokens))
        found = []
        for size, (keys, posts) in self.sketch.items():
            h = _runs(numbers, size)
            h = h[h != 0]
            if not len(h):
                continue
            h = np.unique(h)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            met = {i for k in at[keys[at] == h] for i in posts[k]}
            spelt = None
            for i in sorted(met):
                item_id, _, hashes, own = self.items[i]
                if np.isin(hashes, h, assume_unique=True).sum() < math.ceil(self.containment * len(own) - 1e-9):
                    continue
                spelt = spelt or {tuple(tokens[j : j + size]) for j in range(len(tokens) - size + 1)}
                shared = len(own & spelt)
                if shared >= math.ceil(self.containment * len(own) - 1e-9):
                    found.append((item_id, shared, len(own)))
        return found


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Broadcast]:
    """The items, broadcast in blocks of about `block_bytes` of text; one pass over the documents each."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == block).orderBy("doc_id", "text")
        yield items.sparkSession.sparkContext.broadcast([(r[0], (r[1] or "").encode()) for r in own.collect()])


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, shared, shingles, containment for each item that a document holds."""
    rows = id_and_text(docs)
    parts = []
    for held in _blocks(id_and_text(benchmark, item_id, item_text), block_bytes):

        def make(held=held):
            index = Index(held.value, shingle, containment)

            def work(batch: pa.RecordBatch) -> dict | None:
                out: dict[str, list] = {n: [] for n in ("doc_id", "item_id", "shared", "shingles", "containment")}
                for doc_id, text in zip(batch.column(0).to_pylist(), raw(batch, "text")):
                    for item, shared, n in index.search(text):
                        for name, value in zip(out, (doc_id, item, shared, n, shared / n)):
                            out[name].append(value)
                return out if out["doc_id"] else None

            return work

        parts.append(by_batch(rows, FOUND, make))
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows that hold no benchmark item, with the columns of `docs`; no row is shuffled."""
    for held in _blocks(id_and_text(benchmark, item_id, item_text), block_bytes):

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Index(held.value, shingle, containment)
            for batch in batches:
                yield batch.filter(pa.array([not index.search(t) for t in raw(batch, text_col)], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
