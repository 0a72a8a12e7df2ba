"""Near-equal lines by a segment-partition edit join, and documents without repeated ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged, text_or_empty, unstaged
from sluice.llm.components import components
from sluice.llm.textbatch import U, RunHashes, mix

_CHAR_BASE = 0xA0761D6478BD642F
#: Rows in one Arrow batch of lines or of pairs of lines.
LINE_BATCH = 2048
#: Index entries from which a segment's list is compared in blocks, rows of a block, and pairs of
#: them that are compared at once (a few MB).
LONG, BLOCK, PAIRS = 8, 512, 4096
#: Bins into which a line's characters are counted.
BINS = 64
#: Lines sampled to find the segments that many rows have, the rows among them that make a segment
#: common, and tasks over which its rows are spread. They set the load of tasks, not the result.
SAMPLE, COMMON, SALTS = 50_000, 64, 64


def code_points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the lines, and each line's length."""
    joined = "".join(lines)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.array(
        [len(x) for x in lines], np.int64)


def segment_keys(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, probe?, key) rows of the join: edits + 1 segments a line, and its probes.

    Of two lines within so many edits, one segment of the shorter stands in the longer, shifted
    by no more than the edits before or after it allow. Keys hold the indexed line's length and
    the segment's number, so that only lines of fitting lengths meet. Unshifted segments of lines
    of one length meet as indexed rows and are no probes.
    """
    chars, size = code_points(lines)
    begin = np.cumsum(size) - size
    hashes = RunHashes(mix(chars.astype(U), 0x11E), _CHAR_BASE)
    parts = edits + 1
    rows, probes, keys = [], [], []

    def add(which, start, length, indexed, number, probe):
        key = hashes.of(begin[which] + start, begin[which] + start + length)
        rows.append(which)
        probes.append(np.full(len(which), probe))
        keys.append(mix(key, 0) ^ mix(indexed.astype(U) * U(parts) + U(number), 0x5E6))

    for less in range(edits + 1):
        indexed = size - less
        short = parts - indexed % parts
        base = indexed // parts
        for i in range(parts):
            place = i * base + np.maximum(0, i - short)
            length = base + (i >= short)
            if not less:
                ok = np.flatnonzero(base > 0)
                add(ok, place[ok], length[ok], indexed[ok], i, False)
            low = np.maximum(np.maximum(place - i, place + less - (edits - i)), 0)
            high = np.minimum(np.minimum(place + i, place + less + (edits - i)), size - length)
            for shift in range(2 * edits + 1):
                start = low + shift
                ok = np.flatnonzero((start <= high) & (base > 0) & ((less > 0) | (start != place)))
                if len(ok):
                    add(ok, start[ok], length[ok], indexed[ok], i, True)
    return np.concatenate(rows), np.concatenate(probes), np.concatenate(keys)


def letters(chars: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each line's characters counted by bin; an edit changes no more than two of the counts by one."""
    row = np.repeat(np.arange(len(size)), size)
    return np.bincount(row * BINS + chars % BINS, minlength=len(size) * BINS).reshape(-1, BINS).astype(np.int32)


def within(one: list[str], two: list[str], edits: int) -> np.ndarray:
    """Which pairs are within so many edits: banded bit-parallel automata of all pairs at once.

    Bit d of ``state[e]`` says that, with e edits, the text so far fits the pattern up to
    d - edits characters further on; only the 2 * edits + 1 diagonals of the band exist.
    """
    chars_a, size_a = code_points(one)
    chars_b, size_b = code_points(two)
    begin_a, begin_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    n, width = len(one), 2 * edits + 1
    full = U((1 << width) - 1)
    # Before any text: e deletions reach the pattern's first e characters.
    state = [np.full(n, sum(1 << (edits + d) for d in range(e + 1)), U) for e in range(edits + 1)]
    live = np.abs(size_a - size_b) <= edits
    live &= np.abs(letters(chars_a, size_a) - letters(chars_b, size_b)).sum(axis=1) <= 2 * edits
    result = np.zeros(n, bool)

    def settle(done: np.ndarray) -> None:
        bit = (size_a[done] - size_b[done] + edits).astype(U)
        result[done] = (state[edits][done] >> bit) & U(1) == 1

    done = np.flatnonzero(live & (size_b == 0))
    settle(done)
    active = np.flatnonzero(live & (size_b > 0))
    for j in range(int(size_b[active].max(initial=0))):
        letter = chars_b[begin_b[active] + j]
        match = np.zeros(len(active), U)
        for d in range(width):
            at = j + d - edits
            there = (at >= 0) & (at < size_a[active])
            where = begin_a[active] + np.clip(at, 0, np.maximum(size_a[active] - 1, 0))
            if len(chars_a):
                match |= (there & (chars_a[np.minimum(where, len(chars_a) - 1)] == letter)).astype(U) << U(d)
        before = None
        for e in range(edits + 1):
            old = state[e][active]
            new = old & match
            if e:
                # A changed letter, one letter more in the text, or one more in the pattern.
                new |= before | (before >> U(1)) | ((state[e - 1][active] << U(1)) & full)
            before = old
            state[e][active] = new
        alive = state[edits][active] != 0
        ended = size_b[active] == j + 1
        settle(active[alive & ended])
        active = active[alive & ~ended]
        if not len(active):
            break
    return result


def _segments(edits: int, listed: np.ndarray, spread: np.ndarray):
    """Rows of the join. ``_kind`` is 0 for an indexed segment, 1 for a probe and 2 for a row of a
    segment that is known to have a long list. Rows of common segments are dealt over salts; the few
    indexed rows of a segment that is common for its probes go to each of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            row, probe, key = segment_keys(batch.column("_text").to_pylist(), edits)
            line, key = batch.column("_line").to_numpy()[row], key.view(np.int64)
            kind, salt = probe.astype(np.int8), np.zeros(len(key), np.int16)
            if len(listed) + len(spread):
                own = (mix(line.view(U), 0x5A17) % U(SALTS)).astype(np.int16)
                long, common = np.isin(key, listed), np.isin(key, spread)
                kind[long] = 2
                salt = np.where(long | common, own, salt)
                again = np.flatnonzero(common & (kind == 0))
                salt[again] = 0
                copies = np.repeat(again, SALTS - 1)
                line, key, kind = (np.concatenate([x, x[copies]]) for x in (line, key, kind))
                salt = np.concatenate([salt, np.tile(np.arange(1, SALTS, dtype=np.int16), len(again))])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, salt, kind, line)],
                                             names=["_segment", "_salt", "_kind", "_line"])
    return run


_ROWS = "_segment long, _salt short, _kind byte, _line long"


def _common_segments(texts: DataFrame, edits: int, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments that many of some 50,000 sampled lines have: those whose list is long, and others.

    There are no more of them than the sample's rows by ``COMMON``, about ten thousand.
    """
    none = np.empty(0, np.int64)
    sampled = texts.sample(fraction=min(1.0, SAMPLE / max(lines, 1)), seed=8)
    seen = sampled.mapInArrow(_segments(edits, none, none), _ROWS).groupBy("_segment").agg(
        F.count("*").alias("n"), F.count_if(F.col("_kind") == 0).alias("indexed")).where(F.col("n") >= COMMON).collect()
    return tuple(np.array(sorted(r["_segment"] for r in seen if (r["indexed"] > LONG) == long), np.int64)
                 for long in (True, False))


def _lists(segment: np.ndarray, salt: np.ndarray, kind: np.ndarray, line: np.ndarray, old: np.ndarray,
           last: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """What rows sorted by segment, salt and kind give, and the rows that the next ones may meet.

    Indexed rows come first in a segment's run, so that they alone are kept of a run that goes on.
    ``old`` marks rows that an earlier call has answered for.
    """
    new = np.ones(len(line), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (salt[1:] != salt[:-1])
    start = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    indexed = np.add.reduceat(kind == 0, start, dtype=np.int64)
    end, kept = len(line), slice(len(line), None)
    if not last:
        open_list = indexed[-1] <= LONG and (kind[start[-1]:] == 0).all()
        end = start[-1] if open_list else end
        kept = slice(start[-1], None if open_list else start[-1] + min(indexed[-1], LONG + 1))
    rest = [x[kept] for x in (segment, salt, kind, line)]
    rest.append(old[kept] if not last and open_list else np.ones(len(rest[0]), bool))
    ready = ~old & (np.arange(len(line)) < end)
    long = (kind == 2) | (indexed > LONG)[run]
    held = np.flatnonzero(ready & long)
    at = np.flatnonzero(ready & ~long & (indexed[run] > 0) & ~new)
    one, two = [], []
    for k in range(LONG):
        other = start[run[at]] + k
        at, other = (x[(other < at) & (k < indexed[run[at]])] for x in (at, other))
        if not len(at):
            break
        one.append(line[other])
        two.append(line[at])
    one, two = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (one, two))
    apart = one != two
    one, two = one[apart], two[apart]
    nothing = np.zeros(len(held) + len(one), bool)
    nothing[: len(held)] = True
    out = pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([line[held], np.minimum(one, two)])),
         pa.array(np.concatenate([line[held], np.maximum(one, two)]), mask=nothing),
         pa.array(np.concatenate([segment[held], one]), mask=~nothing)], names=["a", "b", "_segment"])
    return out, rest


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines (a, b) of short segment lists, and members (a, _segment) of long ones."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = [batch.column(c).to_numpy() for c in ("_segment", "_salt", "_kind", "_line")]
        rows.append(np.zeros(len(batch), bool))
        if kept is not None:
            rows = [np.concatenate(x) for x in zip(kept, rows, strict=True)]
        out, kept = _lists(*rows, last=False)
        yield out
    if kept is not None and len(kept[0]):
        yield _lists(*kept, last=True)[0]


def _verified(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = within(batch.column("_ta").to_pylist(), batch.column("_tb").to_pylist(), edits)
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])
    return run


def _forest(edits: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        """Links that join all lines of a block that are within reach of each other."""
        ids, lines = block["_line"].to_numpy(), block["_text"].tolist()
        own, size = block["_own"].to_numpy(), block["_text"].str.len().to_numpy()
        across = block["_x"].iloc[0] != block["_y"].iloc[0]
        label = np.arange(len(ids))
        counts = letters(*code_points(lines))
        found = []

        def settle(a: np.ndarray, b: np.ndarray) -> None:
            for at in range(0, len(a), PAIRS):
                i, j = a[at: at + PAIRS], b[at: at + PAIRS]
                new = (label[i] != label[j]) & (np.abs(counts[i] - counts[j]).sum(axis=1) <= 2 * edits)
                i, j = i[new], j[new]
                ok = within([lines[x] for x in i], [lines[x] for x in j], edits)
                for x, y in zip(i[ok], j[ok], strict=True):
                    if label[x] != label[y]:
                        label[label == label[y]] = label[x]
                        found.append((ids[x], ids[y]))

        settle(np.zeros(len(ids) - 1, int), np.arange(1, len(ids)))
        left = np.triu(label[:, None] != label[None, :], 1) & (np.abs(size[:, None] - size[None, :]) <= edits)
        if across:
            left &= own[:, None] != own[None, :]
        settle(*np.nonzero(left))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _in_blocks(members: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Links among the lines of long segment lists, found where the lines are.

    Lists are dealt in blocks, one task for each pair of blocks; only links that join two groups
    leave it.
    """
    counts = members.groupBy("_segment").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("_line"), F.col("_blocks")).cast("int")
    other = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: F.struct(
        F.least("_own", k).alias("x"), F.greatest("_own", k).alias("y")))
    dealt = members.join(counts, "_segment").withColumn("_own", own).withColumn("_pair", F.explode(other)).join(
        texts, "_line")
    return dealt.select("_segment", F.col("_pair.x").alias("_x"), F.col("_pair.y").alias("_y"), "_own", "_line",
                        "_text").groupBy("_segment", "_x", "_y").applyInPandas(_forest(edits), "a long, b long")


def _key(doc_id: str, text: str) -> Column:
    body = text_or_empty(text)
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                    F.xxhash64(body, F.length(body)).alias("text"))


def _classed(line: Column, min_chars: int) -> Column:
    """Lines long enough for the join, and shorter ones with a letter or digit."""
    return (F.length(line) >= min_chars) | line.rlike(r"[\p{L}\p{N}]")


#: Spark's runtime filter for a join whose large side is texts, whatever its size; 8 MB at most.
_RUNTIME_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the wanted lines. Others are mostly left out before the shuffle, by a Bloom filter of
    the wanted numbers; beyond some ten million of them it passes more and more, and in the end Spark
    plans none. The join decides."""
    spark = texts.sparkSession
    before = {name: spark.conf.get(name, None) for name in _RUNTIME_FILTER}
    try:
        for name, value in _RUNTIME_FILTER.items():
            spark.conf.set(name, value)
        # The condition, true of all numbers, is what lets the optimizer plan the filter.
        return staged(texts.join(wanted.where("_line >= 0"), "_line", "left_semi"), "asked")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = 2,
                 min_chars: int = 30, min_documents: int = 10) -> DataFrame:
    """Every line that shares its class with another line.

    Lines of ``min_chars`` characters or more are joined within ``edits``; shorter ones with a
    letter or digit are classed with their equals only, as edits would join most short words.
    Columns: ``_key`` (none, id, text hash of the document), ``line`` (number from 0),
    ``first_id`` and ``first_line`` (where the class first occurs), ``removed``: the class occurs
    in ``min_documents`` documents or more and this is not its first occurrence. A line that
    stands alone is its own class and is never removed, so that none of them is shuffled on.
    """
    spark = docs.sparkSession
    small_batches(spark, LINE_BATCH)
    lines = docs.select(_key(doc_id, text).alias("_key"), F.posexplode(F.split(text_or_empty(text), "\n")).alias("line", "_text"))
    lines = lines.where(_classed(F.col("_text"), min_chars))
    a, b = F.xxhash64("_text"), F.xxhash64(F.lit(7), "_text", F.length("_text"))
    # Equal lines are one row of the join, however often they occur.
    distinct = staged(lines.groupBy(a.alias("_a"), b.alias("_b")).agg(
        F.first("_text").alias("_text"), F.count("*").alias("_copies")).withColumn(
        "_line", F.monotonically_increasing_id()), "lines")
    joined = distinct.where(F.length("_text") >= min_chars).select("_line", "_text")
    listed, spread = _common_segments(joined, edits, distinct.count())
    posted = joined.mapInArrow(_segments(edits, listed, spread), _ROWS)
    # All rows of a segment, or of its salt, meet once, in order: a short list gives its pairs, and
    # the members of a long one are compared in blocks.
    met = staged(posted.repartition("_segment", "_salt").sortWithinPartitions("_segment", "_salt", "_kind").mapInArrow(
        _met, "a long, b long, _segment long"), "met")
    pairs = staged(met.where("b is not null").select("a", "b").distinct(), "line-pairs")
    held = staged(met.where("b is null").select("_segment", F.col("a").alias("_line")).distinct(), "held")
    unstaged(met)
    # Texts are fetched once, of lines in some pair or long list only.
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("_line")).union(
        held.select("_line")).distinct(), "wanted")
    asked = _fetched(distinct.select("_line", "_text"), wanted)
    texts = pairs.join(asked.select(F.col("_line").alias("a"), F.col("_text").alias("_ta")), "a").join(
        asked.select(F.col("_line").alias("b"), F.col("_text").alias("_tb")), "b")
    links = staged(texts.select("a", "b", "_ta", "_tb").mapInArrow(_verified(edits), "a long, b long").union(
        _in_blocks(held, asked, edits)), "line-links")
    roots = components(links)
    classes = distinct.drop("_text").join(roots, distinct["_line"] == roots["node"], "left").where(
        "_copies > 1 or root is not null").select("_a", "_b", F.coalesce("root", "_line").alias("_class"))
    occurrences = staged(lines.select("_key", "line", a.alias("_a"), b.alias("_b")).join(classes, ["_a", "_b"]).drop(
        "_a", "_b"), "occurrences")
    unstaged(distinct, held, pairs, wanted, asked, links, roots)
    by_document = occurrences.groupBy("_class", "_key").agg(F.min("line").alias("line"))
    counts = by_document.groupBy("_class").agg(
        F.count("*").alias("_documents"), F.min(F.struct("_key", "line")).alias("_first"))
    where = F.struct("_key", "line")
    return occurrences.join(counts, "_class").select(
        "_key", "line", F.col("_first._key.id").alias("first_id"), F.col("_first.line").alias("first_line"),
        ((F.col("_documents") >= min_documents) & (where != F.col("_first"))).alias("removed"))


def _by_document(classes: DataFrame) -> DataFrame:
    return classes.groupBy("_key").agg(
        F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line")))).alias("removed_lines"),
        F.sort_array(F.collect_set(F.struct("line", "first_id", "first_line"))).alias("lines"))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 30,
                   **settings: int) -> DataFrame:
    """One row per document: its lines' classes and which lines go.

    Columns: doc_id, n_lines, n_removed, ``removed_lines`` (numbers from 0) and ``lines`` (line,
    first_id, first_line of all lines that are classed). The cases are those of
    ``drop_repeated_lines``.
    """
    found = _by_document(line_classes(docs, doc_id, text, min_chars=min_chars, **settings))
    parts = F.split(text_or_empty(text), "\n")
    long = F.array_compact(F.transform(parts, lambda x, i: F.when(_classed(x, min_chars), i)))
    own = docs.select(_key(doc_id, text).alias("_own"), F.size(parts).cast("long").alias("n_lines"), long.alias("_long"))
    joined = own.join(found, own["_own"].eqNullSafe(found["_key"]), "left")
    shared = F.coalesce("lines", F.array().cast(found.schema["lines"].dataType))
    alone = F.transform(F.array_except("_long", shared["line"]), lambda i: F.struct(
        i.alias("line"), F.col("_own.id").alias("first_id"), i.alias("first_line")))
    return joined.select(
        F.col("_own.id").alias(doc_id), "n_lines",
        F.coalesce(F.size("removed_lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        F.sort_array(F.concat(shared, alone)).alias("lines"))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings: int) -> DataFrame:
    """Documents without the later occurrences of lines that many documents share.

    Lines of ``min_chars`` (30) characters or more that are within ``edits`` (2) insertions,
    deletions or changes of a character of each other are linked; linked lines are one class, and
    so are equal shorter lines with a letter or digit. A class in ``min_documents`` (10) documents or more keeps its first occurrence, by id and line.
    A document all of whose text goes is dropped; other columns stay as they are.

    Cases: a null or empty text has one empty line and stays; short lines without a letter or
    digit stay; rows that agree
    in id and text are one document and decided alike; null ids come last in order of first
    occurrence; an empty table gives an empty one.
    """
    found = _by_document(line_classes(docs, doc_id, text, **settings)).where(F.size("removed_lines") > 0).select(
        F.col("_key").alias("_same"), "removed_lines")
    keyed = docs.withColumn("_own", _key(doc_id, text))
    joined = keyed.join(found, keyed["_own"].eqNullSafe(found["_same"]), "left")
    kept = F.array_join(F.filter(F.split(text_or_empty(text), "\n"), lambda x, i: ~F.array_contains("removed_lines", i)), "\n")
    changed = joined.withColumn(text, F.when(F.col("removed_lines").isNull(), F.col(text)).otherwise(kept))
    emptied = F.col("removed_lines").isNotNull() & ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    return changed.where(~F.coalesce(emptied, F.lit(False))).select(*[f"`{c}`" for c in docs.columns])
