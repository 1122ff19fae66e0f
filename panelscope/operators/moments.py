"""Sums of a numeric kernel over all rows, computed in batches inside tasks.

Where a step needs thousands of sums (a Gram matrix of many terms for each pair
of classes), one SQL expression for each leaves code generation.  Here a task
turns its Arrow batches into a matrix, lets BLAS add them up, and sends one
array; the arrays are added in two steps, so the driver gets one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 8


def sum_kernel(df: DataFrame, columns: Sequence[str], kernel: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``kernel(rows)`` (``size`` numbers) over batches of ``columns``
    as doubles; zeros for an empty frame.  A null cell reads as NaN."""

    def partial(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += kernel(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            for row in batch.column(0):
                total += row.values.to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["s"])

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(partial, "s array<double>")
    return np.array(rows.repartition(PARTS).mapInArrow(add, "s array<double>").repartition(1).mapInArrow(add, "s array<double>").first()[0])
