"""Moving Arrow batches through Python: texts as bytes, rows as numpy arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A-Z lower-cased, every other byte as it is; bytes.lower() does the same and is what the modules use.
ASCII_SPACE = b" \t\n\r\x0b\f"
PART_BYTES = 2_000_000


def map_arrow(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a step that yields dicts of equally long arrays in the order of ``schema``."""
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        for columns in step(batches):
            arrays = [
                values if isinstance(values, (pa.Array, pa.ChunkedArray)) and values.type == f.type else pa.array(values, f.type)
                for values, f in zip(columns.values(), arrow)
            ]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def in_parts(batches: Iterator[pa.RecordBatch], most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut, without copying, into runs of rows of about ``most`` bytes, so that what a step makes of the texts of one
    run stays small; a longer row comes alone."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_bytes(df: DataFrame, text: str = "text") -> DataFrame:
    """The text column as UTF-8 bytes named ``_text``; NULL as empty."""
    return df.withColumn("_text", F.coalesce(F.col(text), F.lit("")).cast("binary")).drop(text)


def numpy_of(column: pa.Array, dtype=np.int64) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(dtype, copy=False)


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths`` values; 0 for empty runs."""
    ends = np.cumsum(lengths)
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[ends] - total[ends - lengths]
