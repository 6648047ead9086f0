"""Cost-balanced packing into sequences of bounded length (operator 4).

A task reads its documents in blocks of bounded token count. Full sequences are cut off the front of
a document; what remains of each document, under one sequence long, is assigned in descending order
of its estimated cost, linear plus quadratic in its length, to the open sequence of lowest cost that
has room for all of it. As many sequences are open as the remainders need; a remainder that fits in
none is cut, its first part filling the roomiest sequence. So every sequence of a block but one comes
out full; the pieces of that one go on to the next block, and from a task's last block to a second
step, which packs the left pieces of many tasks together. No text is shuffled.

Defined cases: null text counts as empty; an empty text is its end id alone; repeated rows and ids,
null ids too, are packed like any other row; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import arrow_schema, id_and_text, schema_of
from molspark.session import materialised

CAPACITY = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / 1024  # cost of n tokens: LINEAR * n + QUADRATIC * n * n
BLOCK_TOKENS = 1_000_000  # token ids that a task holds at once, and one document
LEFT_GROUP = 256  # tasks whose left pieces are packed together, each under one sequence long
END_ID = 1
PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids binary, open boolean"
)
SECOND_STEP = 1 << 62  # sequence ids of the second step start here
#: How the byte-level tokenizer splits a text before it merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Kept words serve texts up to Latin Extended-B; others go through the tokenizer whole.
BEYOND = re.compile(r"[^\x00-\u024F]")
#: Where white space stands before a space, the split isn't at that space.
RUNS = [c + " " for c in "\t\n\v\f\r \x85\xa0"]
KEPT_WORDS = 300_000  # words whose ids a worker keeps at hand, and as many older ones


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    stand for themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder(dict):
    """Token ids of whole texts, little-endian unsigned 32-bit, by a byte-level BPE tokenizer file.

    The tokenizer splits a text first, at every single space among others, and merges inside the parts.
    So equal words after a space have equal ids, and those are kept; a word not met before is merged by
    the file's own vocabulary as ranks. Other texts go through the tokenizer whole, among them those
    that hold a special token written out, which the tokenizer gives its own id as it does by default.
    """

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        byte_of = _byte_of()
        self.special = special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in self.tokenizer.get_vocab().items()
            if token not in special
        }
        self.ranks = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.marks = {mark: self._whole(mark) for mark in ",."}

    def _whole(self, text: str) -> bytes:
        return array("I", self.ranks.encode_ordinary(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        """The ids of a word after a space."""
        ids = self.older.get(word)
        if ids is not None:
            pass
        elif word.isalpha():
            ids = array("I", self.ranks._core_bpe.encode_single_piece((" " + word).encode())).tobytes()
        elif word[:-1].isalpha() and word[-1] in ",.":
            ids = self[word[:-1]] + self.marks[word[-1]]
        else:
            ids = self._whole(" " + word)
        self[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special) or not text.isascii() and BEYOND.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if any(r in text for r in RUNS):
            return self._whole(text)
        if len(self) > KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        parts = text.split(" ")
        first = self._whole(parts[0])
        del parts[0]
        return first + b"".join(map(self.__getitem__, parts))


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    return Encoder(path)


def balance(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, first token, tokens) holding all pieces; at most one is not full.

    Pieces, each at most `capacity` long, go in descending order of cost to the sequence of lowest
    cost with room for all of the piece; one that fits nowhere is cut and fills the roomiest first.
    """
    total = sum(lengths)
    count = -(-total // capacity)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    room, spent = np.full(count, capacity), np.zeros(count)
    if total % capacity:
        room[-1] = total % capacity
    for piece in sorted(range(len(lengths)), key=lambda i: (-cost(lengths[i]), i)):
        start, rest = 0, lengths[piece]
        while rest:
            fits = room >= rest
            k = int(np.where(fits, spent, np.inf).argmin()) if fits.any() else int(room.argmax())
            part = min(rest, int(room[k]))
            out[k].append((piece, start, part))
            room[k] -= part
            spent[k] += cost(part)
            start, rest = start + part, rest - part
    return out


class _Block:
    """Pieces that wait for a sequence: (doc_id, start, doc_tokens, ids)."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.pieces: list[tuple[int | None, int, int, bytes]] = []
        self.tokens = 0

    def add(self, piece: tuple[int | None, int, int, bytes]) -> None:
        self.pieces.append(piece)
        self.tokens += len(piece[3]) // 4

    def sequence(self, members: list[tuple[int | None, int, int, bytes]], is_open: bool) -> list[tuple]:
        rows, at = [], 0
        for doc_id, start, doc_tokens, ids in members:
            n = len(ids) // 4
            rows.append((doc_id, start, n, doc_tokens, self.next_id, at, ids, is_open))
            at += n
        self.next_id += 1
        return rows

    def pack(self, last: bool) -> list[tuple]:
        """Rows of the full sequences; the pieces of the one that isn't full wait on, or come out open."""
        held, rows = self.pieces, []
        self.pieces, self.tokens = [], 0
        for members in balance([len(p[3]) // 4 for p in held], self.capacity):
            cut = [
                (held[i][0], held[i][1] + at, held[i][2], held[i][3][4 * at : 4 * (at + n)]) for i, at, n in members
            ]
            if sum(len(p[3]) for p in cut) == 4 * self.capacity:
                rows += self.sequence(cut, False)
            elif last:
                rows += self.sequence(cut, True)
            else:
                for piece in cut:
                    self.add(piece)
        return rows


def _columns(rows: list[tuple]) -> dict[str, list]:
    names = [p.split()[0] for p in PIECES.split(", ")]
    return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}


def _pieces(docs: DataFrame, tokenizer: str, capacity: int, block_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PIECES)
        encode, end = encoder(tokenizer), np.array([END_ID], "<u4").tobytes()
        block = _Block(capacity, TaskContext.get().partitionId() << 32)

        def out(rows):
            made = _columns(rows)
            return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in schema], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                n = len(ids) // 4
                cut, full = n - n % capacity, []
                for at in range(0, cut, capacity):
                    full += block.sequence([(doc_id, at, n, ids[4 * at : 4 * (at + capacity)])], False)
                if full:
                    yield out(full)
                if cut < n:
                    block.add((doc_id, cut, n, ids[4 * cut :]))
                if block.tokens >= block_tokens:
                    yield out(block.pack(False))
        rows = block.pack(True)
        if rows:
            yield out(rows)

    return docs.mapInArrow(run, schema_of(PIECES))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    block_tokens: int = BLOCK_TOKENS,
    left_group: int = LEFT_GROUP,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ids are the piece's token ids, little-endian unsigned 32-bit. Only the pieces of each task's one
    sequence that isn't full are shuffled, in groups of `left_group` tasks.
    """
    pieces = materialised(_pieces(id_and_text(docs), tokenizer, capacity, block_tokens))
    columns = [p.split()[0] for p in PIECES.split(", ") if not p.startswith("open")]

    def again(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        block = _Block(capacity, SECOND_STEP + (int(key[0]) << 32))
        left = left.sort_values(["sequence_id", "offset"])
        ids = [None if pd.isna(d) else int(d) for d in left["doc_id"]]
        for piece in zip(ids, left["start"], left["doc_tokens"], left["ids"]):
            block.add(piece)
        made = _columns(block.pack(True))
        made["doc_id"] = pd.array(made["doc_id"], "Int64")
        return pd.DataFrame({c: made[c] for c in columns})

    left = (
        pieces.where("open")
        .withColumn("part", F.expr(f"(sequence_id >> 32) div {left_group}"))
        .groupBy("part")
        .applyInPandas(again, schema_of(", ".join(p for p in PIECES.split(", ") if not p.startswith("open"))))
    )
    return pieces.where("NOT open").select(*columns).unionByName(left)
