"""Whitening of vectors along their leading principal components."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged
from sluice.llm.eigen import leading_pairs
from sluice.llm.vectors import carried, kept_vectors, matrix

BATCH = 4096
LONG = (1 << 63) - 1
#: Whole numbers stay below this size, so that sums over a batch are exact in 64 bits.
LARGEST = 1 << 40
#: A component counts if its variance is above this share of the largest, else it is rounding.
LEAST_SHARE = 1e-12


def _whole(column: pa.Array, dim: int, scale: int, shift: int) -> np.ndarray:
    whole = np.floor(scale * matrix(column, dim))
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more")
    return whole.astype(np.int64) + shift


def _exact_sums(kept: DataFrame, add_up, cells: str) -> list:
    """Sums of ``n`` by cell, in decimals, of what tasks have added up; one row for each cell."""
    keys = cells.split()
    small_batches(kept.sparkSession, BATCH)
    schema = ", ".join(f"{k} int" for k in keys) + ", s decimal(38,0)"
    return kept.select("v").mapInArrow(add_up, schema).groupBy(*keys).agg(F.sum("s").alias("s")).collect()


def _rows(cells: list, sums: list[int], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c.astype(np.int32)) for c in cells], pa.array(sums, pa.decimal128(38, 0))], [*names, "s"])


def totals(kept: DataFrame, dim: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each component."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [0] * (dim + 1)
        for batch in batches:
            if batch.num_rows:
                own = _whole(batch.column(0), dim, scale, shift).sum(axis=0).tolist()
                sums = [a + b for a, b in zip(sums, [*own, batch.num_rows], strict=True)]
        if sums[dim]:
            yield _rows([np.arange(dim + 1)], sums, ["i"])

    found = {r["i"]: int(r["s"]) for r in _exact_sums(kept, add_up, "i")}
    return found.get(dim, 0), [found.get(i, 0) for i in range(dim)]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact products of all pairs of columns, summed over the rows."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 1 << 53:
        exact = y.astype(np.float64)
        return (exact.T @ exact).astype(np.int64).astype(object)
    exact = y.astype(object)
    return exact.T @ exact


def covariance(kept: DataFrame, dim: int, n: int, sums: list[int], scale: int, shift: int) -> np.ndarray:
    """n * n times the covariance, as whole numbers: n * sum of (x - m)(x - m)' less a remainder.

    Components are centred at m, the whole number next to their mean, before they are
    multiplied; what the mean differs from m is taken off exactly at the end. So nothing is
    lost to rounding, whatever the order in which tasks are added up.
    """
    centre = [(2 * s + n) // (2 * n) for s in sums]
    i, j = np.triu_indices(dim)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((dim, dim), object)
        rows = 0
        for batch in batches:
            if batch.num_rows:
                rows += batch.num_rows
                found = found + _products(_whole(batch.column(0), dim, scale, shift) - np.array(centre))
        if rows:
            yield _rows([i, j], [int(x) for x in found[i, j]], ["i", "j"])

    out = np.zeros((dim, dim), object)
    for r in _exact_sums(kept, add_up, "i j"):
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["s"])
    rest = np.array([s - n * m for s, m in zip(sums, centre, strict=True)], object)
    return n * out - np.outer(rest, rest)


def _projection(dim: int, n: int, sums: list[int], onto: np.ndarray, scale: int, shift: int):
    """Deviation and whitened components of each vector."""
    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            whole = _whole(column, dim, scale, shift)
            limit = max(abs(n * int(whole.max(initial=0)) - min(sums)), abs(n * int(whole.min(initial=0)) - max(sums)))
            exact = whole if dim * limit * limit <= LONG else whole.astype(object)
            apart = n * exact - np.array(sums, exact.dtype)
            squares = (apart * apart).sum(axis=1)
            deviation = pa.array([int(x) if x <= LONG else None for x in squares], pa.int64())
            centred = apart.astype(np.float64) / n
            ends = np.arange(len(whole) + 1, dtype=np.int32) * onto.shape[1]
            white = pa.ListArray.from_arrays(pa.array(ends), pa.array((centred @ onto).ravel()))
            yield pa.StructArray.from_arrays([deviation, white], ["deviation", "whitened"])

    return project


def _identity_error(white: DataFrame, count: int) -> float:
    """Largest entry of the components' covariance less the identity; centred, then multiplied."""
    parts = [F.col("made.whitened")[k] for k in range(count)]
    means = white.agg(*[F.avg(p) for p in parts]).first()
    apart = [p - F.lit(m) for p, m in zip(parts, means, strict=True)]
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    found = white.agg(*[F.avg(apart[a] * apart[b]) for a, b in pairs]).first()
    return max(abs(c - (a == b)) for c, (a, b) in zip(found, pairs, strict=True))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = 8,
           scale: int = 1024, shift: int = 100_000, keep_vector: bool = True) -> DataFrame:
    """One row for each vector that counts and component: its whitened projection.

    Components of a vector become whole numbers floor(scale * c) + shift. Adds component (from 1,
    by falling variance), n, deviation (squared distance of n * x from the sums), whitened,
    explained (share of all variance) and identity_error (one value). Sums and covariance are
    exact, so the result doesn't depend on the order of tasks. What is collected and sent out is
    as large as the covariance of one vector's components.

    Cases: vectors that are null, empty or have null or non-finite parts are dropped, and those
    of another length than the vector with the smallest id. Components whose variance is zero,
    or rounding beside the largest, have no rows; so a table of equal vectors, or an empty one,
    gives an empty result. A deviation too large for a long is null. A scaled component of 2**40
    or more is an error. Rows of one id, or without one, count each. Other columns stay, but for
    those with an output's name; ``keep_vector=False`` leaves the vector out.
    """
    outputs = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    row = carried(vectors, outputs, None if keep_vector else embedding)
    kept, dim = kept_vectors(vectors, vec_id, embedding, row)
    n, sums = totals(kept, dim, scale, shift) if dim else (0, [])
    values, onto, trace = np.empty(0), np.empty((dim, 0)), 1.0
    if n:
        spread = covariance(kept, dim, n, sums, scale, shift)
        trace = float(Fraction(int(np.trace(spread)), n * n))
        exact = np.array([[float(Fraction(int(x), n * n)) for x in r] for r in spread])
        values, found = leading_pairs(exact, components)
        real = values > LEAST_SHARE * max(values[0], 0.0)
        values, onto = values[real], found[:, real] / np.sqrt(values[real])
    small_batches(vectors.sparkSession, BATCH)
    project = _projection(dim, n, sums, onto, scale, shift)
    if len(values):
        white = staged(kept.select("row", project("v").alias("made")), "whitened")
        error = _identity_error(white, len(values))
    else:
        white = kept.limit(0).select("row", F.lit(None).cast(
            "struct<deviation: bigint, whitened: array<double>>").alias("made"))
        error = 0.0
    shares = F.array(*[F.lit(float(v / trace)) for v in values]).cast("array<double>")
    spread_out = white.select("row", "made.deviation", F.posexplode("made.whitened").alias("k", "whitened"))
    return spread_out.select(
        "row.*", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("k")].alias("explained"), F.lit(float(error)).alias("identity_error"))
