"""Exact token counts at every prefix of a text.

``with_prefix_counts`` finds, by dynamic programming over the byte prefixes of
each piece, how many tokens every prefix of a text has, and stores them as one
signed byte per character (the change each character makes). Counts, truncation
points and budget questions are then answered from that column, without
encoding again: ``count_of_prefix``, ``chars_within``.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.llm import byte_bpe
from labelweave.llm.common import table, whole_text

LIMIT = 512


def with_prefix_counts(df, text="text", path=None, n_tokens="n_tokens", steps="prefix_steps"):
    """Adds the token count of the text and the step of every character.

    Null counts as the empty text, which has no tokens and no steps. Special
    strings inside a text are single tokens, as the library reads them; their
    inner prefixes count as ordinary text. Columns of these names are replaced.
    """
    @F.pandas_udf("n long, steps binary")
    def count(texts: pd.Series) -> pd.DataFrame:
        bpe = byte_bpe.load(path)
        found = [bpe.text_steps(t) for t in texts]
        return pd.DataFrame({"n": [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in found],
                             "steps": found})

    return (df.withColumn("__counted", count(whole_text(text)))
            .withColumns({n_tokens: F.col("__counted.n"), steps: F.col("__counted.steps")})
            .drop("__counted"))


@F.pandas_udf(T.LongType())
def count_of_prefix(steps: pd.Series, chars: pd.Series) -> pd.Series:
    """Tokens of the first ``chars`` characters; more than the text has means all."""
    return pd.Series([int(np.frombuffer(s, np.int8)[:max(int(n), 0)].sum(dtype=np.int64))
                      for s, n in zip(steps, chars)], dtype="int64")


@F.pandas_udf(T.LongType())
def chars_within(steps: pd.Series, budget: pd.Series) -> pd.Series:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    def longest(step, most):
        counts = np.frombuffer(step, np.int8).cumsum(dtype=np.int64)
        if not len(counts) or counts[-1] <= most:
            return len(counts)
        fitting = np.flatnonzero(counts <= most)
        return int(fitting[-1]) + 1 if len(fitting) else 0
    return pd.Series([longest(s, n) for s, n in zip(steps, budget)], dtype="int64")


def op1_token_counts(spark, sf_dir):
    """doc_id, n_bytes, n_tokens, over_limit, and how many characters fit the limit."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = with_prefix_counts(docs)
    return counted.select(
        "doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        chars_within("prefix_steps", F.lit(LIMIT)).alias("limit_chars"))
