"""Arrow batches of documents of limited size for work inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows handed to Python code at a time; one document may be long, so batches are small.
ROWS = 500


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict[str, object]], schema: StructType | str
) -> DataFrame:
    """Apply ``work``, which returns output columns by name, to slices of at most ``ROWS`` rows."""
    target = df.sparkSession.createDataFrame([], schema).schema
    fields = to_arrow_schema(target)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = work(batch.slice(start, ROWS))
                yield pa.RecordBatch.from_arrays(
                    [_array(out[f.name], f.type) for f in fields], schema=fields
                )

    return df.mapInArrow(run, target)


def _array(values: object, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; NULL is empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]
