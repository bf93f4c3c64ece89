"""Embeddings as rows that may take part in cosine search, and as matrices inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.llm.shared import two_hashes


def usable(vector: str) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite part, not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda e: e.isNotNull() & (F.abs(e) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda e: e != 0), F.lit(False))


def usable_vectors(table: DataFrame, id_col: str, vector: str, label: str | None) -> DataFrame:
    """(vec_id, label, vector, h1, h2) of the rows that take part; h1, h2 name equal vectors.

    Vectors take part if their length is the commonest (ties: the longer).
    """
    h1, h2 = two_hashes(F.col("vector"))
    rows = (
        table.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            (F.col(f"`{label}`") if label else F.lit(0)).alias("label"),
            F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        )
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
        .withColumns({"h1": h1, "h2": h2})
    )
    sizes = rows.groupBy(F.size("vector").alias("d")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long vectors as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest part goes first so that no square overflows."""
    if not rows.size:
        return rows
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the row of ``b`` beside it, from the original values."""
    dots = (a * b).sum(axis=1)
    return dots / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
