"""Near-duplicate vectors by spherical-cap filters from structured random product codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged, without
from sluice.llm.components import components
from sluice.llm.ranks import runs_for

#: Random vectors that share a filter with one vector, on average, at most; sets the caps' size.
BY_CHANCE = 4.0
#: Filters that a vector exceeds on average, at first and at most. More are taken until so large a
#: share of random pairs at the linking cosine meets in a filter, measured on so many pairs.
FILTERS, MOST = 22.0, 400.0
RECALL, TRIALS = 0.985, 2000
#: Filters that every vector is given, its best ones if it exceeds fewer.
LEAST = 12
#: Rows of one side of a compared block.
BLOCK = 512


class ProductCode:
    """Filter directions (u, v) / sqrt(2): u and v from two random codes over half the dimensions.

    A random rotation comes first, so that no coordinate weighs more than another. A vector
    exceeds a filter if its part along it is at least ``level`` standard deviations of a random
    direction's. List decoding sorts both codes' parts and walks the second only as far as the
    sum can still reach the level.
    """

    def __init__(self, dim: int, rows: float, seed: int = 5, filters: float = FILTERS):
        share = min(0.00135, BY_CHANCE / max(rows, 1.0))
        self.words = max(2, round((filters / share) ** 0.5))
        rng = np.random.default_rng(seed)
        size = max(2, dim)
        # Cosine that this share of random directions reaches: the tail of (1 - x**2)**((size-3)/2).
        x = np.arange(-1 + 5e-6, 1, 1e-5)
        tail = np.cumsum(((1 - x * x) ** ((size - 3) / 2))[::-1])
        self.level = x[::-1][np.searchsorted(tail, share * tail[-1])] * size ** 0.5
        self.turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
        half = size // 2
        self.half, self.size = half, size
        code = [rng.standard_normal((self.words, n)) for n in (half, size - half)]
        self.code = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in code]

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """All exceeded filters of each unit vector."""
        if unit.shape[1] < self.size:
            unit = np.pad(unit, ((0, 0), (0, self.size - unit.shape[1])))
        turned = unit @ self.turn
        scale = (self.size / 2) ** 0.5
        left = turned[:, : self.half] @ self.code[0].T * scale
        right = turned[:, self.half:] @ self.code[1].T * scale
        found = []
        for a, b in zip(left, right, strict=True):
            order = np.argsort(-b)
            reach = np.searchsorted(-b[order], a - self.level, side="right")
            hit = np.flatnonzero(reach)
            if reach.sum() < LEAST:  # then its best filters, which lie among the best of each code
                i, j = np.argsort(-a)[:LEAST], order[:LEAST]
                best = np.argsort(-(a[i][:, None] + b[j][None, :]), axis=None)[:LEAST]
                found.append(i[best // len(j)].astype(np.int64) * self.words + j[best % len(j)])
                continue
            n = reach[hit]
            second = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            found.append(np.repeat(hit, n).astype(np.int64) * self.words + second)
        return found


    def met(self, cosine: float, pairs: int = TRIALS, seed: int = 1) -> float:
        """Share of random pairs at this cosine that meet in a filter."""
        rng = np.random.default_rng(seed)
        hits = 0
        for done in range(0, pairs, 200):
            one, off = rng.standard_normal((2, min(200, pairs - done), self.size))
            one /= np.linalg.norm(one, axis=1, keepdims=True)
            off -= (off * one).sum(axis=1, keepdims=True) * one
            off /= np.linalg.norm(off, axis=1, keepdims=True)
            two = cosine * one + max(0.0, 1 - cosine * cosine) ** 0.5 * off
            hits += sum(len(np.intersect1d(a, b)) > 0 for a, b in zip(self.decode(one), self.decode(two), strict=True))
        return hits / pairs


def fitted_code(dim: int, rows: float, cosine: float, seed: int = 5) -> ProductCode:
    """A code whose filters are as many as ``RECALL`` takes at this cosine and number of rows."""
    filters, before = FILTERS, None
    while True:
        code = ProductCode(dim, rows, seed, filters)
        missed = 1 - code.met(cosine)
        if missed <= 1 - RECALL or filters >= MOST:
            return code
        if before is None or filters >= 2 * before[0]:
            if before is not None and missed > 0.8 * before[1]:
                return before[2]  # in few dimensions more filters are the same ones again
            before = filters, missed, code
        # At least what it would take if filters missed a pair independently of each other.
        more = np.log(1 - RECALL) / np.log(min(missed, 0.9))
        filters = min(MOST, filters * max(1.3, more))


def _units(vectors) -> np.ndarray:
    raw = np.array([np.asarray(v, np.float64) for v in vectors])
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _shared_before(filters: list[np.ndarray], own: int, other: list[np.ndarray]) -> np.ndarray:
    """For two lists of rows: do both exceed a filter with a lower number than this one."""
    ids = np.unique(np.concatenate([f[f < own] for f in (*filters, *other)]))

    def rows(lists):
        out = np.zeros((len(lists), len(ids)), np.float32)
        for i, f in enumerate(lists):
            out[i, np.searchsorted(ids, f[f < own])] = 1
        return out

    return rows(filters) @ rows(other).T > 0 if len(ids) else np.zeros((len(filters), len(other)), bool)


def _least_reached(linked: np.ndarray) -> np.ndarray:
    """The lowest row that each row of a square link matrix reaches."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 label: str = "label", cosine: float = 0.93, seed: int = 5) -> DataFrame:
    """Add n_links, component_id and kept to each vector.

    Vectors with equal labels link at a cosine of ``cosine`` or more in double precision. Equal
    vectors of a label are one row of the search with a count. Each is posted under all filters
    that it exceeds; rows of one label and filter are compared in blocks of some hundred rows
    each, and a block with many rows is dealt over as many tasks as it has pairs of blocks, so
    that no bucket is cut or sampled. A pair is counted under the first filter that it shares;
    of the links themselves only a spanning forest of each block leaves its task. The caps follow
    the number of vectors of the largest label, so that random vectors meet a bounded number of
    others, and the number of filters follows the caps and the cosine (``fitted_code``), so that
    the chance to miss a link does not grow with the table. Every counted link is verified. The
    code's words, which are broadcast, grow with the root of the rows: 13,000 at ten million.

    Cases: a vector that is null, empty, zero, or has null or non-finite parts, and one without
    label, links with nothing; vectors of different lengths don't link; rows with one id are one
    vector for the result if their vectors and labels agree, else each is counted for its own
    and they share the component of the id; rows without id link, but don't name a component;
    an empty table gives an empty one; other columns stay, and of columns with an output's name
    only the output remains.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2048)
    outputs = ["n_links", "component_id", "kept"]
    given = without(vectors, *outputs).withColumn("_v", F.col(embedding).cast("array<double>"))
    fine = (F.col(label).isNotNull() & (F.size("_v") > 0)
            & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("_v", lambda x: x != 0))
    given = given.withColumn("_v", F.when(F.coalesce(fine, F.lit(False)), F.transform("_v", lambda x: x + F.lit(0.0))))
    key = [F.col(label).cast("string").alias("_label"), F.xxhash64("_v").alias("_a"),
           F.xxhash64(F.lit(7), "_v", F.size("_v")).alias("_b")]
    keyed = given.select("*", *key)
    classes = staged(
        keyed.where("_v is not null").groupBy("_label", "_a", "_b").agg(
            F.first("_v").alias("_v"), F.count("*").alias("_copies"),
            F.min(vec_id).alias("_first")).withColumn("_class", F.monotonically_increasing_id()),
        "vectors")
    sizes = classes.groupBy("_label", F.size("_v").alias("_dim")).agg(F.count("*").alias("n")).groupBy().agg(
        F.max("n").alias("n"), F.max("_dim").alias("dim")).first()
    if sizes["n"] is None:
        return keyed.select(
            *[F.col(f"`{c}`") for c in given.columns if c != "_v"], F.lit(0).cast("long").alias("n_links"),
            F.col(vec_id).alias("component_id"), F.col(vec_id).isNotNull().alias("kept"))
    code = spark.sparkContext.broadcast(fitted_code(sizes["dim"], sizes["n"], cosine, seed))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            lengths = np.array([len(v) for v in batch["_v"]])
            filters = np.empty(len(batch), object)
            for n in np.unique(lengths):
                own = np.flatnonzero(lengths == n)
                for i, f in zip(own, code.value.decode(_units(batch["_v"].iloc[own])), strict=True):
                    filters[i] = np.sort(f)
            batch["_filters"] = filters
            yield batch

    schema = "_class long, _label string, _v array<double>, _copies long, _filters array<long>"
    decoded = staged(classes.select("_class", "_label", "_v", "_copies").mapInPandas(decode, schema), "filters")
    posted = decoded.select("_class", "_label", F.size("_v").alias("_dim"), F.explode("_filters").alias("_filter"))
    bucket = ["_label", "_dim", "_filter"]
    counts = staged(posted.groupBy(*bucket).agg(F.count("*").alias("_n")).where("_n > 1").withColumn(
        "_blocks", F.ceil(F.col("_n") / BLOCK).cast("int")), "buckets")
    # Buckets of one block share tasks' groups of about so many rows; each is compared by itself.
    groups = runs_for(counts.agg(F.sum("_n").alias("n")).first()["n"] or 0, 4 * BLOCK)
    met = posted.join(counts, bucket).join(decoded.drop("_label"), "_class")
    own = F.pmod(F.xxhash64("_class"), F.col("_blocks")).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda k: F.struct(
        F.least(own, k).alias("x"), F.greatest(own, k).alias("y")))
    dealt = met.withColumn("_own", own).withColumn("_pair", F.explode(blocks)).select(
        *bucket, F.col("_pair.x").alias("_x"), F.col("_pair.y").alias("_y"), "_own",
        F.when(F.col("_blocks") == 1, F.pmod(F.xxhash64(*bucket), F.lit(groups))).otherwise(
            F.xxhash64(*bucket, "_pair.x", "_pair.y")).alias("_group"),
        "_class", "_v", "_copies", "_filters")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = [compared(block) for _, block in group.groupby([*bucket, "_x", "_y"], sort=False)]
        return pd.concat([f for f in found if len(f)] or found[:1])

    def compared(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_class")
        this = int(block["_filter"].iloc[0])
        unit, own = _units(block["_v"]), block["_own"].to_numpy()
        ids, copies = block["_class"].to_numpy(), block["_copies"].to_numpy()
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        if block["_x"].iloc[0] != block["_y"].iloc[0]:  # two blocks: pairs across them only
            linked &= own[:, None] != own[None, :]
        hit = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(hit, hit)]
        ids, copies = ids[hit], copies[hit]
        if not len(hit):
            return pd.DataFrame({"_class": [], "_links": [], "_with": []}, dtype="int64")
        lists = [np.asarray(f) for f in block["_filters"].iloc[hit]]
        new = linked & ~_shared_before(lists, this, lists)
        return pd.DataFrame({"_class": ids, "_links": new @ copies, "_with": ids[_least_reached(linked)]})

    found = staged(dealt.groupBy("_group").applyInPandas(
        compare, "_class long, _links long, _with long"), "links")
    roots = components(found.select(F.col("_class").alias("a"), F.col("_with").alias("b")))
    links = found.groupBy("_class").agg(F.sum("_links").alias("_links"))
    classed = classes.join(links, "_class", "left").join(
        roots, classes["_class"] == roots["node"], "left").select(
        "_label", "_a", "_b", F.coalesce("root", "_class").alias("_root"), "_first",
        (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"))
    classed = staged(classed, "classes")
    least = classed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    classed = classed.join(least, "_root").drop("_root", "_first")
    joined = keyed.join(classed, ["_label", "_a", "_b"], "left")
    component = F.coalesce("component_id", vec_id)
    return joined.select(
        *[F.col(f"`{c}`") for c in given.columns if c != "_v"],
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col(vec_id) == component, F.lit(False)).alias("kept"))
