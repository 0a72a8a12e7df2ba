"""Document rules, hosts judged by shrunken failure rates, and verdicts for documents.

Built-in functions only. Per document the work is linear in its words, except for one sort of
the window hashes of a text in which a window repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import SPACES, staged, without, words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Rules whose failures are counted by host. The first two are the base rules of a document.
RULES = ["few_words", "repeated", "symbols", "same_lines"]
WINDOW = 5


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once, though it is used more than once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(hashes: Column) -> Column:
    """Words under windows whose hash occurs twice or more.

    Places of repeated windows are found next to each other in the sorted (hash, place) list;
    in their own order each adds the distance to the next one, at most a window's length.
    """
    def places(pairs: Column) -> Column:
        def same(i: Column, by: int) -> Column:
            return F.coalesce(F.get(pairs, i)["h"] == F.get(pairs, i + by)["h"], F.lit(False))

        found = F.transform(pairs, lambda p, i: F.when(same(i, -1) | same(i, 1), p["i"]))
        return F.sort_array(F.array_compact(found))

    def length(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda n, x: n + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(_let(pairs, places), length)


def rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words to each document."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rest = without(docs, *COUNTS)
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = rest.withColumn("_words", words(F.col(text).cast("string"))).withColumn("_lines", lines)
    window = F.transform(
        F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get("_words", i + k) for k in range(1, WINDOW)]))
    counted = counted.withColumn("_windows", window)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return counted.select(
        *[f"`{c}`" for c in rest.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _covered(F.col("_windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def failures(symbol_share: float = 0.1, line_repeats: int = 10) -> dict[str, Column]:
    """Each rule's verdict of one document, from its counts."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repeated": F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n,
        "symbols": F.col("n_symbols") > symbol_share * n,
        "same_lines": F.col("n_dup_lines") > line_repeats,
    }


def beta_prior(hosts: DataFrame, rule: str) -> tuple[Column, Column]:
    """Aggregates for the strengths of a rule's failures and passes in an empirical beta prior.

    Method of moments over hosts: the rates' variance, less what counting a few documents adds,
    gives the prior's weight in documents, between 1 and 10,000.
    """
    rate = F.col(rule) / F.col("n")
    mean = F.avg(rate)
    chance = mean * F.avg(1 / F.col("n")) - F.avg(rate * rate / F.col("n"))
    between = F.greatest(F.var_pop(rate) - F.greatest(chance, F.lit(0.0)), F.lit(1e-9))
    weight = F.greatest(F.lit(1.0), F.least(F.lit(10_000.0), mean * (1 - mean) / between - 1))
    return (mean * weight).alias(f"{rule}_failed"), ((1 - mean) * weight).alias(f"{rule}_passed")


def judge_hosts(counted: DataFrame, host: str, most: float = 0.5, **limits) -> DataFrame:
    """One row per host (``_host``, null as its own): documents, shrunken rates, verdict.

    A host is rejected if a rule's shrunken failure rate is above ``most``. Failures are
    partially aggregated, so that a host with a third of all documents is no hot task. The prior
    is four pairs of numbers and goes back to the hosts as constants.
    """
    rules = failures(**limits)
    hosts = staged(counted.groupBy(F.col(host).cast("string").alias("_host")).agg(
        F.count("*").alias("n"),
        *[F.sum(failed.cast("long")).alias(rule) for rule, failed in rules.items()]), "hosts")
    prior = hosts.agg(*[c for rule in RULES for c in beta_prior(hosts, rule)]).first()
    rates = [((F.col(r) + F.lit(prior[f"{r}_failed"] or 0.0))
              / (F.col("n") + F.lit((prior[f"{r}_failed"] or 0.0) + (prior[f"{r}_passed"] or 1.0)))
              ).alias(f"{r}_rate") for r in RULES]
    judged = hosts.select("_host", "n", *rates)
    return judged.withColumn("host_rejected", F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > most)


def host_rules(docs: DataFrame, text: str = "text", host: str = "source", keep_text: bool = True,
               most: float = 0.5, **limits) -> DataFrame:
    """Add the counts, base_failed, host_rejected and kept to each document.

    ``base_failed``: fewer than 10 words, or over a fifth of the words repeated. A document that
    passes is kept if its host passes; on a rejected host it has to pass all rules, so that a
    clean document outlives a bad neighbourhood. ``keep_text=False`` leaves the text out of the
    result and of the intermediate table.

    Cases: a null or empty text has no words and fails; a null host is a host of its own;
    repeated rows count and are judged each; an empty table gives an empty one; other columns
    stay, and of columns with an output's name only the output remains.
    """
    outputs = [*COUNTS, "base_failed", "host_rejected", "kept"]
    counted = rule_counts(without(docs, *outputs), text)
    counted = staged(counted if keep_text else without(counted, text), "rules")
    hosts = judge_hosts(counted, host, most, **limits).select("_host", "host_rejected")
    rules = failures(**limits)
    base = rules["few_words"] | rules["repeated"]
    any_rule = base | rules["symbols"] | rules["same_lines"]
    joined = counted.join(
        hosts, counted[host].cast("string").eqNullSafe(hosts["_host"]), "left").drop("_host")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.withColumn("host_rejected", rejected).withColumn("base_failed", base).withColumn(
        "kept", ~F.when(F.col("host_rejected"), any_rule).otherwise(base))
