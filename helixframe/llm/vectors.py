"""What the operators on embeddings share: valid rows, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(column: str):
    """A vector that is not null, has no null, NaN or infinite component, and is not all zero."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return c.isNotNull() & fine & F.exists(c, lambda x: x != 0)


def classes(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(class, vector) with one row for each distinct vector, and (key, class); the class is its least key.

    Vectors are told apart by two 64-bit hashes. Counts are merged before the shuffle, so one vector that
    a third of all rows share is no burden to a task.
    """
    keyed = df.select(F.col(key).cast("bigint").alias(key), F.col(vector).alias("vector"))
    keyed = keyed.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})
    least = keyed.groupBy("h1", "h2").agg(F.min(key).alias("class"))
    members = keyed.join(least, ["h1", "h2"])
    return members.where(F.col(key) == F.col("class")).select("class", "vector").dropDuplicates(["class"]), members.select(key, "class")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long vectors as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
