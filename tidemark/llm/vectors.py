"""Integer vectors for the operators that work on exact whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest magnitude of a scaled component: squared distances of up to 512 such components stay below 2^63.
LIMIT = 1 << 26


def whole(vec: Column) -> Column:
    """True where a vector is there and has neither null nor non-finite components."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))


def scaled(vec: Column, scale: int) -> Column:
    """Components x as integers floor(scale * x), x taken as double. A component beyond ``LIMIT`` ends the
    query with an error: sums and distances are exact or not given at all."""
    def one(x: Column) -> Column:
        y = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(y) <= LIMIT, y.cast("int")).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond {LIMIT}")).cast("int"))
    return F.transform(vec, one)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long lists without nulls as a matrix of int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def vector_sums(partials: DataFrame, keys: list[str], dim: int) -> DataFrame:
    """``partials`` (keys, n, s: array of ``dim`` longs) summed by key: ``n``, ``s``."""
    sums = partials.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dim)])
    return sums.select(*keys, "n", F.array(*[F.col(f"s{j}") for j in range(dim)]).alias("s"))
