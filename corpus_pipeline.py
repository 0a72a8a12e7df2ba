"""A training corpus from raw documents: rules, lines, near copies, mixture, packing.

Each stage is a function of (spark, docs, sf_dir) to a frame; ``run`` writes each result to the
shared folder and gives it, read back, to the next. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.best_fit import pack_documents
from sluice.llm.common import staged
from sluice.llm.host_rules import host_rules
from sluice.llm.line_join import drop_repeated_lines
from sluice.llm.minhash_join import near_documents
from sluice.llm.systematic import mix
from sluice.session import prepare


def _ready(spark: SparkSession) -> SparkSession:
    """The session's settings, and plain Parquet reads.

    Each thread of a vectored read keeps direct buffers as large as the column chunks it has read,
    outside the heap and for the executor's life; one stage after the other adds to them.
    """
    prepare(spark).conf.set("parquet.hadoop.vectored.io.enabled", "false")
    return spark


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict keep."""
    _ready(spark)
    return host_rules(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later occurrences of lines that two documents or more share."""
    _ready(spark)
    return drop_repeated_lines(docs, min_documents=2)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, linked from a similarity of 0.8."""
    _ready(spark)
    return near_documents(docs, percent=80).where("kept").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    _ready(spark)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mix(docs).where("copies > 0").select(*docs.columns, copies.alias("_copy")).drop("_copy")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    _ready(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", source_mix),
    ("best-fit packing", packing),
]

#: SQL has no tokenizer, edit automaton or MinHash; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage{k}")
    return docs
