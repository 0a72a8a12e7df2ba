"""What the operators on vectors share: which vectors count, and batches of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """The vector in doubles if it has parts and all of them are finite numbers, else null."""
    v = vector.cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), v)


def carried(vectors: DataFrame, outputs: list[str], dropped: str | None = None) -> Column:
    """The caller's columns in one struct, so that no name of ours can meet one of theirs.

    Columns with the name of an output, in any case, are left out, and so is ``dropped``.
    """
    taken = {n.lower() for n in outputs} | {(dropped or "").lower()}
    return F.struct(*[F.col(f"`{c}`") for c in vectors.columns if c.lower() not in taken])


def kept_vectors(vectors: DataFrame, vec_id: str, embedding: str, row: Column,
                 *more: Column) -> tuple[DataFrame, int]:
    """Rows (row, id, v, more) with a finite vector of the usual length, and that length.

    The usual length is that of the row with the smallest id, nulls last.
    """
    all_of_them = vectors.select(row.alias("row"), F.col(vec_id).alias("id"),
                                 finite(F.col(embedding)).alias("v"), *more).where("v IS NOT NULL")
    first = all_of_them.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(1).collect()
    dim = len(first[0]["v"]) if first else 0
    return all_of_them.where(F.size("v") == dim), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow array of lists of ``dim`` doubles as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)
