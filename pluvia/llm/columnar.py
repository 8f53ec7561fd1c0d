"""Arrow batches as NumPy arrays: the shared ground of the text operators.

A Spark task hands its rows over in Arrow batches. ``add_columns`` runs a function on each of them and
appends what it returns; ``text_chunks`` cuts a column of texts into pieces of bounded size, never
inside a text.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 3 << 20


def text_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES, most: int = 1 << 16
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, UTF-8 bytes, offsets of the rows in them). A null is an empty text.

    A chunk holds at most ``most`` rows and ``limit`` bytes, or one longer text.
    """
    column = pc.fill_null(column, "")
    rows = len(column)
    if not rows:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), first + most, rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def add_columns(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    make: Callable[[pa.RecordBatch], list[pa.Array]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` with the columns that ``make`` computes from each Arrow batch.

    ``keep`` names the columns that stay (all by default). A new column replaces one of the same name.
    """
    names = {name.lower() for name, _ in fields}
    left = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in left] + [T.StructField(n, t) for n, t in fields])

    def run(batches):
        for batch in batches:
            made = make(batch)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in left]
            yield pa.RecordBatch.from_arrays(columns + made, names=[*left, *(n for n, _ in fields)])

    return df.mapInArrow(run, schema)


def nested(docs: DataFrame, *beside: str) -> DataFrame:
    """The columns ``beside`` as they are, all others inside one struct ``held`` under names of its own, where no
    column that an operator adds can replace them."""
    inner = [F.col(_quoted(c)).alias(f"c{k}") for k, c in enumerate(docs.columns) if c not in beside]
    return docs.select(*beside, F.struct(F.lit(True).alias("any"), *inner).alias("held"))


def restored(df: DataFrame, docs: DataFrame, *beside: str) -> DataFrame:
    """The columns of ``docs`` from rows that ``nested`` made of it."""
    return df.select([F.col(c) if c in beside else F.col(f"held.c{k}").alias(c) for k, c in enumerate(docs.columns)])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def learned(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object | None:
    """What ``fit`` makes of all rows of ``sample``; None if there are none.

    ``sample`` has a limit that the caller documents. It is gathered in one task, which a lost executor
    repeats, and only the model comes to the driver.
    """

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(table))], pa.binary())], names=["model"])

    made = sample.coalesce(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = starts - (ends - lengths)
    kind = np.int32 if max(total, int(np.max(starts, initial=0)) + total) < 2**31 else np.int64
    return np.arange(total, dtype=kind) + np.repeat(shift.astype(kind), lengths)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def bucket(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; a null value counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus
