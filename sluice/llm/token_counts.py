"""Token counts of whole texts by the whole-token shortcut."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sluice.llm.bpe import shipped_encoder, whole_tokens
from sluice.llm.common import small_batches, text_or_empty, without


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (n_tokens > limit) to each document.

    ``tokenizer`` is the path of a byte-level BPE in the tokenizers format, to be found under
    that path on every machine. The vocabulary strings that encode alone as one token are proven
    once on the driver and broadcast; their size is bounded by the vocabulary. No shuffle.

    Cases: a null or empty text has 0 bytes and 0 tokens; repeated rows stay, each with its
    count; an empty table gives an empty one; other columns stay as they are, and of columns
    with an output's name only the output remains. A text is counted whole, however long.
    """
    small_batches(docs.sparkSession)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer))

    @F.pandas_udf(LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = shipped_encoder(tokenizer, whole.value, ids=False).encode
        return pd.Series([encode(t) for t in texts], dtype="int64")

    rest = without(docs, "n_bytes", "n_tokens", "over_limit")
    counted = rest.withColumn("n_bytes", F.octet_length(text_or_empty(text)).cast("long")).withColumn(
        "n_tokens", count(text_or_empty(text)))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
