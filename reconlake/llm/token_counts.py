"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proven once, on the driver, from the
vocabulary (bounded: one entry per token). On the executors a pre-token in that set counts one;
only the rest is merged. Rows are never shuffled, and a task holds one Arrow batch and the bounded
lookup tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.llm import bpe, workers


def token_counter(spark: SparkSession, tokenizer_path: str):
    """A function from a text column to its number of tokens; special tokens are never added."""
    workers.importable(spark)
    shared = spark.sparkContext.broadcast(bpe.load_vocabulary(tokenizer_path))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = bpe.counting_encoder(shared.value).encode
        for texts in batches:
            yield pd.Series([encode(text) for text in texts], dtype="int64")

    return tokens


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    A NULL text is an empty one: 0 bytes, 0 tokens. Repeated rows give repeated results, a NULL id
    stays NULL, an empty table gives no rows, and other columns are not looked at.
    """
    counter = token_counter(docs.sparkSession, tokenizer_path)
    whole: Column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = docs.select(F.col(f"`{id_column}`").alias("doc_id"), whole.alias("whole_text"))
    counted = kept.select(
        "doc_id",
        F.octet_length("whole_text").cast("long").alias("n_bytes"),
        counter("whole_text").alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
