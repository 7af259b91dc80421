"""Vectors as binary columns: validity, dimension, conversion to numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm.common import prepare


def valid_vectors(frame: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and vec (little-endian doubles) of the rows that can be compared.

    Null and empty vectors, zero vectors and those with null or non-finite
    components are left out. Vectors of several lengths stay; ``by_length``
    gives each length on its own, as no measure compares two of them.
    """
    prepare(frame.sparkSession)
    v = F.col(vector)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
    v = F.col("v")
    rows = rows.filter(v.isNotNull() & F.forall(v, number) & F.exists(v, lambda x: x != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8").tobytes()
            end = (8 * np.cumsum(b.column(1).value_lengths().to_numpy(zero_copy_only=False))).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat[s:e] for s, e in zip([0, *end], end)], pa.binary())], ["vec_id", "vec"])
    return rows.mapInArrow(run, "vec_id bigint, vec binary")


def by_length(valid: DataFrame) -> list[DataFrame]:
    """The rows of ``valid_vectors`` of each length; the lengths of a table are few."""
    lengths = sorted(r[0] for r in valid.select(F.octet_length("vec")).distinct().collect())
    return [valid.filter(F.octet_length("vec") == n) for n in lengths] if len(lengths) > 1 else [valid]


def matrix(column: pa.Array | pa.ChunkedArray | list) -> np.ndarray:
    """Binary vectors -> rows of doubles."""
    values = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1 if values else 0)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares of tiny or huge components stay in range."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))
