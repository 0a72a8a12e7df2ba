"""Vector compression to codebook indexes, with nearest entries found by memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged
from sluice.llm.vectors import carried, kept_vectors, matrix

#: Cells across the widest component of a codebook.
ACROSS = 8
#: Cells that a task remembers for one part before it starts anew; bounds its memory only.
REMEMBERED = 1 << 16
#: Parts are whole numbers below this size, so that squared distances are exact in 64 bits.
LARGEST = 1 << 28
BATCH = 4096


class GridCells:
    """Nearest entries of one part's codebook.

    Space is cut into cubes. For a cube the entries that may be nearest to some point of it are
    those whose least distance to it is not above the smallest of all entries' greatest
    distances. They are worked out when a point first falls into the cube and remembered under
    the cube's coordinates; only they are evaluated for its points.
    """

    def __init__(self, entries: np.ndarray, remembered: int = REMEMBERED):
        self.entries = entries
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max()) if entries.size else 0
        self.width = max(1, spread // ACROSS)
        self.remembered = remembered
        self.cells: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        entries = self.entries[None, :, :]
        gap = np.maximum(np.maximum(low - entries, entries - high), 0)
        reach = np.maximum(np.abs(entries - low), np.abs(entries - high))
        least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
        possible = least <= most.min(axis=1)[:, None]
        return [np.flatnonzero(p) for p in possible]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, the lowest of equals, and its squared distance."""
        cells = np.ascontiguousarray(points // self.width)
        keys = cells.view(np.dtype((np.void, cells.dtype.itemsize * cells.shape[1]))).ravel()
        _, at, cell_of = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in at]
        if len(self.cells) + len(names) > self.remembered:
            self.cells.clear()
        new = [k for k, name in enumerate(names) if name not in self.cells]
        # A few cells at a time, as each is compared with all entries.
        for k in range(0, len(new), 512):
            own = new[k: k + 512]
            for i, found in zip(own, self._candidates(cells[at[own]]), strict=True):
                self.cells[names[i]] = found
        lists = [self.cells[name] for name in names]
        sizes = np.array([len(x) for x in lists])
        starts = np.cumsum(sizes) - sizes
        count = sizes[cell_of]
        first = np.cumsum(count) - count
        entry = np.concatenate(lists)[
            np.arange(count.sum()) - np.repeat(first - starts[cell_of], count)]
        apart = np.repeat(points, count, axis=0) - self.entries[entry]
        distance = (apart * apart).sum(axis=1)
        self.evaluated += len(distance)
        least = np.minimum.reduceat(distance, first)
        index = np.where(distance == np.repeat(least, count), entry, len(self.entries))
        return np.minimum.reduceat(index, first), least


def _whole(column: pa.Array, dim: int, scale: int, parts: int) -> np.ndarray:
    """Vectors as whole numbers, by part: (parts, rows, width)."""
    whole = np.floor(scale * matrix(column, dim))
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more")
    return np.ascontiguousarray(whole.astype(np.int64).reshape(-1, parts, dim // parts).swapaxes(0, 1))


def _sums(kept: DataFrame, dim: int, scale: int, books: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """Number of parts nearest to each entry, and their sums; entries without parts aren't there.

    A task sends at most one row for each entry, so what is shuffled doesn't grow with its rows,
    and what is collected is as large as the codebooks.
    """
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [GridCells(b) for b in books]
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, points in enumerate(_whole(batch.column(0), dim, scale, parts)):
                index, _ = grids[p].nearest(points)
                totals[p, :, 0] += np.bincount(index, minlength=entries)
                for j in range(width):  # whole numbers below 2**53, so exact in doubles
                    totals[p, :, j + 1] += np.bincount(index, points[:, j], entries).astype(np.int64)
        part, entry = np.nonzero(totals[:, :, 0])
        found = totals[part, entry]
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)),
                 *[pa.array(found[:, j]) for j in range(width + 1)]],
                ["part", "entry", *[f"s{j}" for j in range(width + 1)]])

    schema = "part int, entry int, " + ", ".join(f"s{j} long" for j in range(width + 1))
    small_batches(kept.sparkSession, BATCH)
    added = kept.select("v").mapInArrow(add_up, schema).groupBy("part", "entry").agg(
        *[F.sum(F.col(f"s{j}").cast("decimal(38,0)")).alias(f"s{j}") for j in range(width + 1)])
    return {(r["part"], r["entry"]): [int(x) for x in r[2:]] for r in added.collect()}


def _trained(kept: DataFrame, dim: int, scale: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    seeds = kept.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    start = pa.array([r["v"] for r in seeds], pa.list_(pa.float64()))
    books = _whole(start, dim, scale, parts)
    for _ in range(rounds):
        for (p, e), (n, *sums) in _sums(kept, dim, scale, books).items():
            books[p, e] = [s // n for s in sums]
    return books


def train_codebooks(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
                    parts: int = 16, entries: int = 64, rounds: int = 2) -> np.ndarray:
    """Codebooks (parts, entries, width) of whole numbers, from rounds over all vectors.

    They start as the parts of the vectors with the smallest ids, nulls last; their size is
    bounded by the parameters and the vectors' length. Without vectors there are no entries.
    """
    kept, dim = kept_vectors(vectors, vec_id, embedding, F.struct(vec_id))
    return _trained(kept, dim, scale, parts, entries, rounds) if dim else np.zeros((parts, 0, 0), np.int64)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _encoder(books: np.ndarray, dim: int, scale: int):
    parts = len(books)

    @F.arrow_udf("struct<code: string, error: bigint>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grids = [GridCells(b) for b in books]
        for column in batches:
            codes = np.empty((len(column), parts), np.uint8)
            error = np.zeros(len(column), np.int64)
            if len(column):
                for p, points in enumerate(_whole(column, dim, scale, parts)):
                    codes[:, p], distance = grids[p].nearest(points)
                    error += distance
            text = codes.tobytes().hex()
            step = 2 * parts
            yield pa.StructArray.from_arrays(
                [pa.array([text[i: i + step] for i in range(0, len(text), step)], pa.string()),
                 pa.array(error)], ["code", "error"])

    return encode


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
             scale: int = 256, parts: int = 16, entries: int = 64, rounds: int = 2,
             keep_vector: bool = True) -> DataFrame:
    """Add code, error, label_error and codebooks_sha256 to each vector that counts.

    Components become floor(scale * x). Each of ``parts`` equal parts of a vector has a
    codebook of up to 256 entries (see ``train_codebooks``). The code holds the index of each part's
    nearest entry, two hex digits each; ``error`` is the sum of squared distances, ``label_error``
    the errors' sum over all vectors of an equal label, where nulls are equal. All of it is exact.

    Cases: vectors that are null, empty or have null or non-finite parts are dropped, and those
    of another length than the vector with the smallest id; a length that isn't a multiple of
    ``parts`` and a scaled component of 2**28 or more are errors. Rows of one id are each encoded,
    and start the codebooks in the order of id (nulls last), then vector. With fewer vectors than
    entries a codebook has one entry a vector. An empty table gives an empty one. Other columns
    stay, but for those with an output's name; ``keep_vector=False`` leaves the vector out.
    """
    outputs = ["code", "error", "label_error", "codebooks_sha256"]
    row = carried(vectors, outputs, None if keep_vector else embedding)
    kept, dim = kept_vectors(vectors, vec_id, embedding, row, F.col(label).alias("label"))
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    books = _trained(kept, dim, scale, parts, entries, rounds) if dim else np.zeros((parts, 0, 0), np.int64)
    small_batches(vectors.sparkSession, BATCH)
    coded = staged(kept.select("row", "label", _encoder(books, dim, scale)("v").alias("coded")), "codes")
    totals = coded.groupBy("label").agg(F.sum("coded.error").alias("label_error"))
    return coded.join(totals, coded["label"].eqNullSafe(totals["label"])).select(
        "row.*", "coded.code", "coded.error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
