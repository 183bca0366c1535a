"""Arrow batches of bounded size for text operators."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

ROWS_PER_BATCH = "512"
BYTES_PER_BATCH = 8 << 20
BYTES_PER_SLICE = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Send few rows, and few bytes unless a row alone has more, at a time to Python.

    A batch stands in the JVM, on its way and in the worker, once more as Python objects, for each
    core of an executor; with long texts or sets its bytes, not its rows, set what that takes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def slices(batch: pa.RecordBatch, text: str, limit: int = BYTES_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of ``batch`` of about ``limit`` bytes of text, a longer text alone."""
    column = batch.column(batch.schema.get_field_index(text))
    if not len(column):
        return
    sizes = np.array([0 if x is None else x for x in pc.binary_length(column).to_pylist()], np.int64)
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(column)]
    for low, high in zip(cuts, cuts[1:]):
        yield batch.slice(low, high - low)
