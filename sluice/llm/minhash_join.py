"""Near-duplicate documents by an inverted join on MinHash signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import small_batches, staged, text_or_empty, unstaged, without
from sluice.llm.components import components
from sluice.llm.textbatch import U, Words, mix, window_hashes

SHINGLE = 5
#: Coordinates of a signature, and how often a pair whose similarity is exactly the limit may share
#: too few of them to be verified; copies that are nearer share more.
COORDINATES, MISSED = 96, 1e-6
#: Rows of one side of a compared block, and pairs whose signatures are compared at once (3 MB a side).
BLOCK, PAIRS = 512, 4096
#: Texts in one Arrow batch; hashing takes some 50 bytes for each of theirs.
TEXTS = 64


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter one's words are one shingle."""
    found = Words(texts, lower=True)
    hashes = found.hashes()
    place, window = window_hashes(hashes, found.doc, SHINGLE)
    first = np.searchsorted(place, found.first)
    for i, n in enumerate(found.count):
        if n >= SHINGLE:
            yield np.unique(window[first[i]: first[i + 1]])
        elif n:
            yield window_hashes(hashes[found.first[i]: found.first[i] + n], np.zeros(n), n)[1]
        else:
            yield np.empty(0, U)


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return b"".join(int(mix(shingles, seed).sum(dtype=U)).to_bytes(8, "big") for seed in (11, 12))


def _signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's hash, marked with its coordinate."""
    least = np.full(len(seeds), np.iinfo(U).max, U)
    for part in range(0, len(shingles), 4096):
        values = (shingles[part: part + 4096, None] ^ seeds[None, :]) * (seeds | U(1))[None, :]
        least = np.minimum(least, values.min(axis=0))
    return mix(least ^ seeds).view(np.int64)


def _seeds() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=U), 0xD0C5)


def least_matches(percent: int) -> int:
    """How many coordinates two documents must share to be verified, at this limit of similarity.

    The most that a pair at the limit shares but for a chance of ``MISSED``; one at least.
    """
    same = percent / 100
    chance = [comb(COORDINATES, k) * same ** k * (1 - same) ** (COORDINATES - k) for k in range(COORDINATES)]
    fewer, least = chance[0], 1
    while least < COORDINATES and fewer + chance[least] <= MISSED:
        fewer, least = fewer + chance[least], least + 1
    return least


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = _seeds()
    for batch in batches:
        digests, sizes, signatures = [], [], []
        for shingles in shingle_sets(batch.column("_text")):
            sizes.append(len(shingles))
            digests.append(_digest(shingles) if len(shingles) else None)
            signatures.append(_signature(shingles, seeds) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(signatures, pa.list_(pa.int64()))],
            names=["_id", "_digest", "_size", "_signature"])


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column("_text")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            names=["_digest", "_set"])


def _postings(classes: DataFrame, matches: int) -> DataFrame:
    """Signature coordinates that another class has too: (_class, _prefix, _score) rows.

    A class needs ``matches`` coordinates that occur elsewhere; others are skipped whole. Two
    classes that share so many meet in the rarest ``shared - matches + 1`` of either, in one
    order of all coordinate values, so that frequent values are seldom posted. The score, the
    number of classes met in all coordinates, is high for the middle of a group of copies.
    """
    posted = classes.select("_class", F.explode("_signature").alias("_value"))
    counts = posted.groupBy("_value").agg(F.count("*").alias("_n")).where("_n > 1")
    shared = posted.join(counts, "_value").groupBy("_class").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_value"))).alias("_shared"))
    return shared.where(F.size("_shared") >= matches).select(
        "_class", F.transform(F.slice("_shared", 1, F.size("_shared") - (matches - 1)),
                              lambda s: s["_value"]).alias("_prefix"),
        F.aggregate("_shared", F.lit(0).cast("long"), lambda n, s: n + s["_n"]).alias("_score"))


def _linked(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures match often enough and whose full sets link."""
    def side(frame: DataFrame, name: str, column: str) -> DataFrame:
        return frame.select(F.col("_class").alias(name), F.col(column).alias(f"_{name}"))

    merged = pairs.join(side(signatures, "a", "_signature"), "a").join(side(signatures, "b", "_signature"), "b")
    counted = merged.where(F.size(F.array_intersect("_a", "_b")) >= least_matches(percent)).select("a", "b")
    full = counted.join(side(sets, "a", "_set"), "a").join(side(sets, "b", "_set"), "b")
    both = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - both
    return full.where(F.lit(100) * both >= F.lit(percent) * union).select("a", "b")


def _compare(percent: int):
    least = least_matches(percent)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        """Links of one block of a posting list, or of two; a spanning forest of them suffices."""
        value = int(block["_value"].iloc[0])
        own, root = block["_own"].to_numpy(), block["_root"].to_numpy()
        across = block["_x"].iloc[0] != block["_y"].iloc[0]
        new = np.triu(root[:, None] != root[None, :], 1)
        if across:
            new &= own[:, None] != own[None, :]
        # A pair belongs to the first posting list that it shares.
        before = [p[p < value] for p in block["_prefix"]]
        ids = np.unique(np.concatenate(before))
        if len(ids):
            member = np.zeros((len(before), len(ids)), np.float32)
            for i, p in enumerate(before):
                member[i, np.searchsorted(ids, p)] = 1
            new &= member @ member.T == 0
        a, b = np.nonzero(new)
        sets = list(block["_set"])
        size = np.array([len(x) for x in sets])
        near = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
        a, b = a[near], b[near]
        signature = np.stack(list(block["_signature"]))
        matches = np.concatenate([np.zeros(0, int), *[
            (signature[a[i: i + PAIRS]] == signature[b[i: i + PAIRS]]).sum(axis=1)
            for i in range(0, len(a), PAIRS)]])
        order = np.argsort(-matches, kind="stable")[: int((matches >= least).sum())]
        above = {r: r for r in root}

        def top(r):
            while above[r] != r:
                above[r] = above[above[r]]
                r = above[r]
            return r

        found = []
        for i, j in zip(a[order], b[order], strict=True):
            one, two = top(root[i]), top(root[j])
            if one != two:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    above[one] = two
                    found.append((i, j))
        ids = block["_class"].to_numpy()
        return pd.DataFrame({"a": [ids[i] for i, _ in found], "b": [ids[j] for _, j in found]}, dtype="int64")
    return run


def _compared(members: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Links between the components that are left in a posting list, from its whole content.

    Lists are dealt in blocks, a long one to as many tasks as it has pairs of blocks. Signatures
    are compared and full sets confirmed where the rows are, so that no pair leaves its task but
    for links that join two components.
    """
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("_class"), blocks).cast("int")
    other = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(
        F.least("_own", k).alias("x"), F.greatest("_own", k).alias("y")))
    dealt = members.withColumn("_own", own).withColumn("_pair", F.explode(other)).join(facts, "_class")
    dealt = dealt.select("_value", F.col("_pair.x").alias("_x"), F.col("_pair.y").alias("_y"), "_own",
                         "_class", "_root", "_signature", "_prefix", "_set")
    return dealt.groupBy("_value", "_x", "_y").applyInPandas(_compare(percent), "a long, b long")


def near_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85,
                   keep_text: bool = True, hub_rounds: int = 2) -> DataFrame:
    """Add n_shingles, component_id and kept to each document.

    Documents whose sets of five-word shingles (A-Z lower-cased) have ``100 * intersection >=
    percent * union`` link; a component is named by its smallest id, and that document is kept.
    Documents with equal sets are one class from the start. Classes are posted under their
    signature's coordinate-value pairs with rare ones first (see ``_postings``); classes of one
    posting list are candidates, first each with the list's hub, once more with another hub, then
    all that are in different components so far (``_compared``): a link inside a component can't
    change a result. Candidates must share ``least_matches(percent)`` coordinates and are
    confirmed on the full sets, which are made for them alone.

    Cases: a null text, or one without words, has no shingles and links with nothing; fewer than
    five words are one shingle; rows with equal texts link, whatever their ids; a row without id
    never names a component unless all are without, and isn't kept; rows with one id and
    different texts are told apart, though both may name a component; an empty table gives an
    empty one; of columns with an output's name only the output remains.
    """
    small_batches(docs.sparkSession, TEXTS)
    outputs = ["n_shingles", "component_id", "kept"]
    given = without(docs, *outputs)
    read = given.select(F.col(doc_id).alias("_id"), text_or_empty(text).cast("binary").alias("_text"))
    id_type = read.schema["_id"].dataType.simpleString()
    key = F.xxhash64(text_or_empty(text), F.length(text_or_empty(text)))
    keyed_read = read.withColumn("_id", F.struct(F.col("_id").alias("id"), F.xxhash64(
        F.col("_text").cast("string"), F.length(F.col("_text").cast("string"))).alias("key")))
    signed = staged(keyed_read.mapInArrow(
        _signed, f"_id struct<id:{id_type},key:long>, _digest binary, _size long, _signature array<long>"), "signed")
    sizes = staged(signed.drop("_signature"), "sizes")
    # One row for each text with words, however often it occurs.
    classes = staged(signed.where("_size > 0").groupBy("_digest").agg(
        F.min(F.struct(F.col("_id.id").isNull().alias("none"), F.col("_id.id").alias("id"),
                       F.col("_id.key").alias("key"))).alias("_rep"),
        F.first("_signature").alias("_signature")).select(
        F.monotonically_increasing_id().alias("_class"), "_digest", F.col("_rep.id").alias("_first"),
        F.col("_rep.key").alias("_key"), "_signature"), "classes")
    unstaged(signed)
    posted = staged(_postings(classes, least_matches(percent)), "posted")
    wanted = staged(posted.select("_class").join(classes, "_class").drop("_prefix"), "wanted")
    named = staged(classes.drop("_signature"), "named")
    unstaged(classes)
    # One text of each class that is a candidate; its copies stay where they are.
    asked = wanted.select(F.col("_first").alias("_wanted"), F.col("_key").alias("_wanted_key"))
    texts = keyed_read.join(asked, F.col("_id.id").eqNullSafe(F.col("_wanted"))
                            & (F.col("_id.key") == F.col("_wanted_key")), "left_semi").dropDuplicates(["_id"])
    made = texts.select("_text").mapInArrow(_with_sets, "_digest binary, _set array<long>")
    sets = staged(made.join(wanted.select("_class", "_digest"), "_digest").groupBy("_class").agg(
        F.first("_set").alias("_set")), "sets")

    lists = staged(posted.select("_class", "_score", F.explode("_prefix").alias("_value")), "lists")
    links, roots, parts = None, None, []
    for turn in range(hub_rounds + 1):
        known = lists.withColumn("_root", F.col("_class")) if roots is None else lists.join(
            roots, lists["_class"] == roots["node"], "left").withColumn("_root", F.coalesce("root", "_class"))
        first = F.col("_score") if not turn else F.xxhash64("_root", F.lit(turn))
        open_lists = staged(known.groupBy("_value").agg(
            F.max(F.struct(first.alias("s"), F.col("_class").alias("hub"), F.col("_root").alias("hub_root"))).alias("_hub"),
            F.min("_root").alias("_r0"), F.max("_root").alias("_r1"), F.count("*").alias("_n")).where(
            "_r0 < _r1").select("_value", "_n", "_hub.hub", "_hub.hub_root"), "open")
        parts.append(open_lists)
        if open_lists.isEmpty():
            break
        if turn == hub_rounds:
            facts = wanted.join(posted.select("_class", "_prefix"), "_class").join(sets, "_class").select(
                "_class", "_signature", "_prefix", "_set")
            new = _compared(known.join(open_lists.select("_value", "_n"), "_value").select(
                "_value", "_n", "_class", "_root"), facts, percent)
        else:
            pairs = known.join(open_lists, "_value").where("_root <> hub_root").select(
                F.least("_class", "hub").alias("a"), F.greatest("_class", "hub").alias("b")).distinct()
            new = _linked(pairs, wanted, sets, percent)
        new = staged(new, "links")
        parts.append(new)
        links = new if links is None else links.union(new)
        before, roots = roots, components(links)
        parts += [before] if before is not None else []
    rooted = named.withColumn("_root", F.col("_class")) if roots is None else named.join(
        roots, named["_class"] == roots["node"], "left").withColumn("_root", F.coalesce("root", "_class"))
    rooted = rooted.select("_digest", "_first", "_root")
    rooted = staged(rooted, "rooted")
    unstaged(named, posted, wanted, sets, lists, *parts, *([roots] if roots is not None else []))
    least = rooted.groupBy("_root").agg(F.min("_first").alias("_component"))
    components_of = rooted.join(least, "_root").select("_digest", "_component")
    result = sizes.join(components_of, "_digest", "left").select(
        "_id", F.col("_size").alias("n_shingles"),
        F.coalesce("_component", "_id.id").alias("component_id"))
    result = result.withColumn(
        "kept", F.coalesce(F.col("_id.id") == F.col("component_id"), F.lit(False)))
    if not keep_text:
        return result.select(F.col("_id.id").alias(doc_id), *outputs)
    # Rows that agree in id and text have one verdict.
    verdicts = result.groupBy("_id").agg(*[F.first(c).alias(c) for c in outputs])
    joined = given.withColumn("_id", F.struct(F.col(doc_id).alias("id"), key.alias("key"))).join(
        verdicts.select(F.col("_id").alias("_same"), *outputs),
        F.col("_id.id").eqNullSafe(F.col("_same.id")) & (F.col("_id.key") == F.col("_same.key")))
    return joined.select(*[F.col(f"`{c}`") for c in given.columns], *outputs)
