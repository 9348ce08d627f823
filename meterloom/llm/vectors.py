"""Valid vectors of an embedding table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & F.coalesce(finite & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(array.flatten()).astype(np.float64)
    return flat.reshape(len(array), -1) if len(array) else flat.reshape(0, 0)
