"""Fill-in-middle transformation with a sparse exception index (operator 13).

A text is cut into units, runs of ASCII letters and single other code points, and two cuts between units
divide it into prefix, middle and suffix, which change places behind marks. Work is on UTF-8 bytes: the
units' starts come from byte masks, a block at a time. Code points and bytes are converted by an
index of exceptions alone: the positions of multibyte characters and how many bytes each has beyond one.
A binary search over them gives what to add or take off; spans of ASCII are plain arithmetic.

Cuts and form are chosen by a hash of the seed and the document's id, so a repeated task and a repeated
row get the same ones.

Defined cases: null text counts as empty, and an empty text stays plain, as does one that holds a mark;
a null doc_id hashes like an empty id; repeated rows give repeated result rows; an empty table gives no
rows; other columns don't matter. No text is shuffled, and a text is held with its masks for one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from molspark.llm.common import arrow_schema, id_and_text, raw, schema_of, text_pieces

#: The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
TRANSFORMED, SUFFIX_FIRST = 90, 20  # per cent of documents; per cent of the transformed ones
BLOCK = 1 << 20  # bytes of a text looked at at once
ROWS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


class Exceptions:
    """The multibyte characters of a UTF-8 text: where they are, and their bytes beyond one.

    `places` are byte positions of first bytes, `more[k]` the excess bytes of the first k of them.
    """

    def __init__(self, text: bytes, block: int = BLOCK):
        places, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not text.isascii():
            for at in range(0, len(text), block):
                b = np.frombuffer(text, np.uint8, min(block, len(text) - at), at)
                first = np.flatnonzero(b >= 0xC0)
                places.append(first + at)
                # A first byte tells the length: from 0xC0 two bytes, from 0xE0 three, from 0xF0 four.
                sizes.append(1 + (b[first] >= 0xE0) + (b[first] >= 0xF0))
        self.places = np.concatenate(places)
        self.more = np.r_[0, np.cumsum(np.concatenate(sizes))]

    def points(self, at: int) -> int:
        """Code points before the byte position `at`, a character's first byte or the end."""
        return int(at - self.more[np.searchsorted(self.places, at)])

    def bytes(self, point: int) -> int:
        """The byte position of the code point numbered `point`."""
        # A multibyte character's number: its place less the excess before it.
        numbers = self.places - self.more[:-1]
        return int(point + self.more[np.searchsorted(numbers, point)])


def unit_starts(text: bytes, at: int, block: int = BLOCK) -> np.ndarray:
    """Byte positions in text[at:at + block] where a unit starts."""
    back = 1 if at else 0
    b = np.frombuffer(text, np.uint8, min(block, len(text) - at) + back, at - back)
    letter = (b | 0x20) - np.uint8(97) < 26
    starts = (b & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(starts[back:]) + at


class Units:
    """How many units a text has, and where some of them start; one block of masks at a time."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self.text, self.block = text, block
        counts = [len(unit_starts(text, at, block)) for at in range(0, len(text), block)]
        self.before = np.r_[0, np.cumsum(counts)].astype(np.int64)
        self.count = int(self.before[-1])

    def start(self, number: int) -> int:
        """The byte position of a unit, or the text's end."""
        if number >= self.count:
            return len(self.text)
        k = int(np.searchsorted(self.before, number, "right")) - 1
        return int(unit_starts(self.text, k * self.block, self.block)[number - self.before[k]])


class Choice(NamedTuple):
    first: int
    second: int
    transformed: bool
    suffix_first: bool


def choose(doc_id: int | None, units: int, seed: int) -> Choice:
    """Cuts and form of a document, from the first four groups of eight hex digits of a hash."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (units + 1), h2 % (units + 1)))
    return Choice(a, b, h3 % 100 < TRANSFORMED, h4 % 100 < SUFFIX_FIRST)


def arranged(prefix: bytes, middle: bytes, suffix: bytes, form: str) -> bytes:
    if form == SPM:
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transformed(doc_id: int | None, text: bytes, seed: int = 1) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, code points of prefix and middle (None if plain), and the output."""
    units = Units(text)
    choice = choose(doc_id, units.count, seed)
    if not text or not choice.transformed or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return units.count, PLAIN, None, None, text
    a, b = units.start(choice.first), units.start(choice.second)
    index = Exceptions(text)
    prefix_chars = index.points(a)
    form = SPM if choice.suffix_first else PSM
    return units.count, form, prefix_chars, index.points(b) - prefix_chars, arranged(text[:a], text[a:b], text[b:], form)


def parts_of(text: bytes, prefix_chars: int, middle_chars: int) -> tuple[bytes, bytes, bytes]:
    """Prefix, middle and suffix of a text by code points."""
    index = Exceptions(text)
    a, b = index.bytes(prefix_chars), index.bytes(prefix_chars + middle_chars)
    return text[:a], text[a:b], text[b:]


def restored(output: bytes, form: str) -> bytes:
    """The text that was transformed. No transformed text holds a mark of its own, and marks don't
    overlap, so the first of each is the one that was put there."""
    if form == PLAIN:
        return output
    first, second = (SUFFIX, PREFIX) if form == SPM else (PREFIX, SUFFIX)
    at, last = output.index(second, len(first)), output.rindex(MIDDLE)
    one, two, middle = output[len(first) : at], output[at + len(second) : last], output[last + len(MIDDLE) :]
    return two + middle + one if form == SPM else one + middle + two


def transform(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (UTF-8) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ROWS)
        for batch in batches:
            for part in text_pieces(batch):
                rows = [transformed(i, t or b"", seed) for i, t in zip(part.column(0).to_pylist(), raw(part, "text"))]
                made = [part.column(0).to_pylist(), *zip(*rows)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema)], schema=schema)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema_of(ROWS))


def restore(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`columns` of transformed rows and `text` (UTF-8), rebuilt from output and form."""
    kept = rows.select(*columns, "form", "output")
    schema = kept.select(*columns, kept["output"].alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, form, output = batch.columns
            text = [restored(o, f) for o, f in zip(output.to_pylist(), form.to_pylist())]
            yield pa.RecordBatch.from_arrays([*others, pa.array(text, pa.binary())], names=[*columns, "text"])

    return kept.mapInArrow(run, schema)
