"""Whole texts through vectorised functions, a bounded number of bytes at a time."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of text that a worker looks at in one go, where it holds numbers for every byte, and
# where it holds distinct words. A longer text is a slice of its own.
SLICE_BYTES, WORD_SLICE_BYTES = 1 << 20, 4 << 20

Added = dict[str, "np.ndarray | pa.Array"]


def kept_in_worker(key: object, make: Callable[[], object]) -> object:
    """What ``make`` returns, made once in a Python worker and kept for its later tasks."""
    store = sys.modules.setdefault("_starloom_kept", types.ModuleType("_starloom_kept")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def texts_of(column: pa.Array) -> pa.Array:
    """A text column with empty texts for nulls, as one array that starts at offset 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.concat_arrays([column.cast(pa.string()).fill_null("")])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins (with the end at last)."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes, or of one text that is longer."""
    ends = text_bytes(texts)[1]
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        yield row, end
        row = end


def add_text_columns(
    df: DataFrame,
    text: str,
    schema: str,
    make: Callable[[], Callable[[pa.Array], Added]],
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Add columns computed from whole texts, all other columns unchanged.

    ``make`` runs once per task and returns a function from an array of texts without
    nulls to the columns of ``schema``. Columns of the input that have the name of a
    new one are replaced.
    """
    fields = T._parse_datatype_string(schema).fields
    new = [field.name for field in fields]
    # The text itself travels once, also where it is one of the columns to keep.
    own_text = text in df.columns and text not in new and dict(df.dtypes)[text] == "string"
    kept = [name for name in df.columns if name not in new and not (own_text and name == text)]
    narrow = df.select(
        F.col(f"`{text}`").cast("string").alias("text"),
        F.struct(*[F.col(f"`{name}`") for name in kept] or [F.lit(0).alias("none")]).alias("row"),
    )
    # Inside, the new columns have names that cannot meet those of the input.
    own = [T.StructField(f"_new_{k}", field.dataType) for k, field in enumerate(fields)]
    out = T.StructType([*narrow.schema.fields, *own] if own_text else [narrow.schema["row"], *own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            passed = batch.columns if own_text else batch.columns[1:]
            texts = texts_of(batch.column(0))
            for begin, end in slices(texts, slice_bytes):
                added = work(texts_of(texts.slice(begin, end - begin)))
                columns = [pa.array(added[name]) for name in new]
                same = [column.slice(begin, end - begin) for column in passed]
                yield pa.RecordBatch.from_arrays([*same, *columns], out.names)

    done = narrow.mapInArrow(run, out)
    place = {name: F.col(f"row.`{name}`") for name in kept} | ({text: F.col("text")} if own_text else {})
    return done.select(
        *[place[name].alias(name) for name in df.columns if name in place],
        *[F.col(field.name).alias(name) for field, name in zip(own, new, strict=True)],
    )
