"""Mixing sources to target weights by systematic sampling, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged, without, words
from sluice.llm.ranks import RUN_ROWS, running_sum

#: Copies are summed in billionths, as whole numbers: no order of addition changes them.
UNIT = 1_000_000_000
#: Random offsets that are drawn for a source.
DRAWS = 16
OUTPUTS = ["size", "source_size", "target", "copies", "taken"]


def ordered_weights(sources: DataFrame, cycle: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """Weights 1, 2, 3, 1, … for sources (``_source``) by code point, null last.

    The rank is made from counts of range partitions, so that not all sources meet in one task.
    """
    first = F.col("_source").isNull()
    dealt = staged(sources.repartitionByRange(first, F.col("_source")).withColumn(
        "_part", F.spark_partition_id()), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(first, "_source"))
    ranked = dealt.join(parts, "_part").withColumn("_rank", own + F.col("_before") - 1)
    weight = F.get(F.array(*map(F.lit, map(float, cycle))), (F.col("_rank") % len(cycle)).cast("int"))
    return ranked.select(*sources.columns, weight.alias("_weight"))


def targets(weighted: DataFrame, share: float = 1.0, most_copies: float = 3.0) -> DataFrame:
    """Add ``target``: a share of all sizes by weight, at most so many times the source's size.

    What a full source leaves over goes to the others by weight. Each round sums up, over all
    sources, what the full ones take and what the others weigh; it ends when no other source
    becomes full, after as many rounds as there are sources at the very most.
    """
    cap = F.col("_source_size") * F.lit(most_copies)
    total = (weighted.agg(F.sum("_source_size").cast("double").alias("s")).first()["s"] or 0.0) * share
    level, full_before = 0.0, -1
    full = F.lit(False)
    while True:
        row = weighted.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)).alias("weight"),
            F.coalesce(F.sum(full.cast("long")), F.lit(0)).alias("full")).first()
        if row["full"] == full_before or not row["weight"]:
            break
        full_before, level = row["full"], (total - row["held"]) / row["weight"]
        full = F.col("_weight") * F.lit(level) > cap
    target = F.when(full, cap).otherwise(F.least(F.col("_weight") * F.lit(level), cap))
    return weighted.withColumn("target", target.cast("double"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: DataFrame | None = None, keep_text: bool = True, share: float = 1.0,
        most_copies: float = 3.0, seed: int = 17) -> DataFrame:
    """Add size, source_size, target, copies and taken (copies * size) to each document.

    The size is the number of words. Within a source, documents expect target / source_size
    copies each; the expectations are prefix-summed from one random offset of the source (of
    sixteen drawn, the one whose words come nearest to the target), and a document is taken once for every whole number that its part of the sum crosses: floor or
    ceil of its expectation. Sources are cut into runs of some 50,000 documents by a hash of the
    id, each sorted by size, so that every size is sampled at the same rate and the words taken
    come near the target. ``weights`` has (source, weight); without it sources weigh 1, 2, 3,
    repeating, by code point.

    Cases: a null or empty text has size 0 and takes nothing; null is a source of its own, last;
    a source without words has target 0; rows that agree in id and size are taken in any order,
    which can't be told apart; an empty table gives an empty one; of columns with an output's
    name only the output remains. Reruns agree, whatever the partitions.
    """
    sized = without(docs, *OUTPUTS).withColumn("size", F.size(words(F.col(text).cast("string"))).cast("long"))
    sized = staged(sized if keep_text else without(sized, text), "sizes")
    sources = sized.groupBy(F.col(source).cast("string").alias("_source")).agg(
        F.sum("size").alias("_source_size"), F.count("*").alias("_rows"))
    if weights is None:
        weighted = ordered_weights(sources)
    else:
        named = weights.select(F.col(weights.columns[0]).cast("string").alias("_named"),
                               F.col(weights.columns[1]).cast("double").alias("_weight"))
        weighted = sources.join(named, sources["_source"].eqNullSafe(named["_named"]), "left").drop(
            "_named").fillna(0.0, ["_weight"])
    plan = targets(staged(weighted, "weighted"), share, most_copies)
    expected = F.when(F.col("_source_size") > 0, F.col("target") / F.col("_source_size")).otherwise(0.0)
    plan = plan.withColumn("_unit", F.round(expected * UNIT).cast("decimal(38,0)")).withColumn(
        "_runs", F.ceil(F.col("_rows") / RUN_ROWS)).drop("_rows", "_weight")
    joined = sized.join(plan, sized[source].cast("string").eqNullSafe(plan["_source"]))
    run = F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.col("_runs"))
    order = [F.col("size"), F.col(doc_id)]
    summed = staged(running_sum(joined, ["_source", "_unit", "target", "_source_size"], run, order, "_unit", "_upto"), "summed")

    def crossed(offset: Column) -> Column:
        upto = (F.col("_upto") + offset).cast("decimal(38,0)")
        return F.call_function("div", upto, F.lit(UNIT)) - F.call_function(
            "div", (upto - F.col("_unit")).cast("decimal(38,0)"), F.lit(UNIT))

    name = F.coalesce("_source", F.lit(""))
    drawn = [F.pmod(F.xxhash64(F.lit(seed + k), name, F.col("_source").isNull()), F.lit(UNIT)) for k in range(DRAWS)]
    # Of a few random offsets each source keeps the one whose words come nearest to its target.
    tried = summed.groupBy("_source").agg(F.first("target").alias("_t"), *[
        F.sum(crossed(offset) * F.col("size")).alias(f"_{k}") for k, offset in enumerate(drawn)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_{k}") - F.col("_t")), F.lit(k)) for k in range(DRAWS)]))
    chosen = tried.select(F.col("_source").alias("_chosen"), F.get(F.array(*[
        F.pmod(F.xxhash64(F.lit(seed + k), name, F.col("_source").isNull()), F.lit(UNIT)) for k in range(DRAWS)]),
        best["col2"]).alias("_offset"))
    summed = summed.join(chosen, summed["_source"].eqNullSafe(chosen["_chosen"]))
    copies = crossed(F.col("_offset"))
    return summed.select(
        *[F.col(f"`{c}`") for c in sized.columns], F.col("_source_size").alias("source_size"), "target",
        copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))
