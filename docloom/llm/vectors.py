"""What the operators on vectors share: the rows that take part, and their entries as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, vector: str, *keep: str) -> DataFrame:
    """keep and vector (as array<double>) of the rows whose vector is not null and has finite entries only.

    Vectors of another length than the most common one (of equally common ones the longest) are left out: they
    share no space with the others.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(*keep, v.alias("vector")).filter(v.isNotNull() & finite)
    most = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = most["size"] if most else 0
    return rows.filter(F.size("vector") == length).withColumn("vector", F.col("vector").cast("array<double>"))


def matrix(batch: pa.RecordBatch, column: str = "vector") -> np.ndarray:
    """The column's vectors as rows; all are of one length."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.empty((0, 0))
