"""Packing of token sequences by bulk-synchronous best fit."""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import shipped_encoder, whole_tokens
from sluice.llm.common import small_batches, staged, text_or_empty
from sluice.llm.ranks import runs_for, running_sum

END_ID = 0


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all are full, but for the first."""
    first = tokens % capacity
    starts = [0] * bool(first) + list(range(first, tokens, capacity))
    return [(s, first if first and not s else capacity) for s in starts]


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 capacity: int = 2048) -> DataFrame:
    """Pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    small_batches(docs.sparkSession)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = shipped_encoder(tokenizer, whole.value, ids=True).encode
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows, pieces = [], []
            for i, text in enumerate(batch.column("_text").to_pylist()):
                ids = encode(text) + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append(i)
                    pieces.append((k, start, length, zlib.crc32(ids[4 * start: 4 * (start + length)])))
            k, start, length, crc = zip(*pieces, strict=True) if pieces else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(rows, pa.int64())), pa.array(k, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=["_id", "piece", "start", "length", "ids_crc32"])

    read = docs.select(F.col(doc_id).alias("_id"), text_or_empty(text).alias("_text"))
    kind = read.schema["_id"].dataType.simpleString()
    return read.mapInArrow(run, f"_id {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("_id", doc_id)


class Moves:
    """Which ranks of a length go to which sequences: the outcome of all sweeps.

    Row k: pieces of ``length[k]`` with ranks from ``rank[k]`` on, up to the next row's, go to
    the sequences ``sequence[k]``, ``sequence[k]`` + 1, … at ``offset[k]``, ``each[k]`` pieces to
    one sequence.
    """

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.rank, self.sequence, self.offset, self.each = table.T
        self.base = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.int64(1) << np.int64(48)
        k = np.searchsorted(self.length * shift + self.rank, length * shift + rank, side="right") - 1
        by = rank - self.rank[k]
        return self.sequence[k] + by // self.each[k], self.offset[k] + by % self.each[k] * length


def sweep(counts: dict[int, int], capacity: int) -> tuple[Moves, int]:
    """Best fit, largest pieces first, over sizes: moves, and the number of sequences.

    ``counts`` has the number of pieces of each length, at most ``capacity`` numbers however
    many pieces there are; open sequences are kept by their gap as ranges of numbers. The pieces
    of a length go to the smallest gap that holds them, in one move for all sequences of that
    gap, as many to each as fit; then to the next larger gap. What no gap holds opens sequences.
    The order is the one in which single best-fit steps would take equal pieces.
    """
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, n: int, gap: int) -> None:
            """Put pieces of this length into sequences first, …, first + n - 1."""
            nonlocal left, rank
            each = gap // length
            used = min(n, left // each)
            if used:
                rows.append((length, rank, first, capacity - gap, each))
                gaps[gap - each * length].append((first, used))
                rank, left = rank + used * each, left - used * each
            if used < n and left and (rest := min(left, each)):
                rows.append((length, rank, first + used, capacity - gap, rest))
                gaps[gap - rest * length].append((first + used, 1))
                rank, left, used = rank + rest, left - rest, used + 1
            if used < n:
                gaps[gap].appendleft((first + used, n - used))

        for gap in sorted(g for g in gaps if g >= length and gaps[g]):
            for _ in range(len(gaps[gap])):
                if not left:
                    break
                fill(*gaps[gap].popleft(), gap)
            if not left:
                break
        if left:
            n = -(-left // (capacity // length))
            first, opened = opened, opened + n
            fill(first, n, capacity)
    return Moves(rows), opened


def pack(pieces: DataFrame, length: str = "length", capacity: int = 2048, tie: list[str] | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces of 1 to ``capacity`` tokens.

    Pieces and gaps are sorted by size, and since sizes are whole numbers up to the capacity,
    equal ones form at most that many size ranges. Each superstep takes the longest pieces left
    and sweeps through the gaps from their successor, the smallest that holds them, upward; which
    of equal pieces gets which of equal gaps is settled by rank; gaps are updated in bulk, and
    the next superstep follows (``sweep``). Only the counts by size, never rows, are on the
    driver; ranks are made by distributed running sums, of runs that a length with a third of all
    pieces is split into, and each piece finds its place by its rank.
    """
    pieces = staged(pieces, "pieces")
    counted = {r[length]: r["count"] for r in pieces.groupBy(length).count().collect()}
    moves, _ = sweep(counted, capacity)
    shipped = pieces.sparkSession.sparkContext.broadcast(moves)
    tie = tie or [c for c in pieces.columns if c != length]
    runs = runs_for(max(counted.values(), default=0))
    ranked = running_sum(pieces.withColumn("_one", F.lit(1).cast("long")), [length],
                         F.pmod(F.xxhash64(*tie), F.lit(runs)), [F.col(c) for c in tie], "_one", "_rank")

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = shipped.value.place(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64) - 1)
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("_at", place(length, "_rank"))
    return placed.select(*[F.col(c) for c in pieces.columns], "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = 2048) -> DataFrame:
    """Pack all documents into sequences: one row per piece with its place.

    A document is its token ids and id 0. Longer ones than ``capacity`` are cut; their first
    piece may be shorter, all others are full. Columns: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    Cases: a null or empty text is the one id 0; repeated rows are packed each; equal pieces are
    placed in any order, which can't be told apart; an empty table gives an empty one; other
    columns aren't read.
    """
    pieces = token_pieces(docs, tokenizer, doc_id, text, capacity)
    return pack(pieces, "length", capacity)
