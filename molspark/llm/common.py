"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; null has none."""
    return (text or b"").lower().split()


def unused(name: str, *tables: DataFrame) -> str:
    """`name`, with underscores added until no table has such a column."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str, kind: str) -> Column:
    """The named column as `kind`; all null where the table has no such column."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just doc_id and text, so other columns of whatever name can't clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow types that mapInArrow must return for a DDL schema of simple types."""
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "string": pa.string(),
        "binary": pa.binary(),
        "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
        "array<float>": pa.list_(pa.float32()),
    }
    return pa.schema([(n.strip(), kinds[k]) for n, k in (p.strip().rsplit(" ", 1) for p in ddl.split(", "))])


def by_batch(df: DataFrame, ddl: str, make: Callable[[], Callable[[pa.RecordBatch], dict | None]]) -> DataFrame:
    """mapInArrow with one `make()` per task; its function turns a batch into columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, schema = make(), arrow_schema(ddl)
        for batch in batches:
            made = work(batch)
            if made is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], type=f.type) if not isinstance(made[f.name], pa.Array) else made[f.name].cast(f.type) for f in schema],
                    schema=schema,
                )

    return df.mapInArrow(run, schema_of(ddl))


def text_pieces(batch: pa.RecordBatch, size: int = 10_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes each in its `text` column; a longer text is one slice."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).to_numpy()
    cut = np.flatnonzero(np.diff(np.cumsum(lengths) // size)) + 1
    for a, b in zip(np.r_[0, cut], np.r_[cut, batch.num_rows]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()
