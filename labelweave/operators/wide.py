"""Tagged tokens to chunks, and chunks to one wide record per text."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import spans as sx
from labelweave.functions.binding import unfold


def with_chunks(df, tokens="tokens", mode="glue", name="chunks"):
    """Adds the list of chunks of an array of (token, tag) structs."""
    return df.withColumn(name, sx.chunks(tokens, mode))


def chunk_rows(df, *keys, chunks="chunks"):
    listed = unfold(df, keys, chunks, "chunk_no", "c")
    return listed.select(*keys, "chunk_no", "c.label", "c.chunk", F.col("c.begin").cast("bigint").alias("begin"),
                         F.col("c.end").cast("bigint").alias("end"))


def wide_record(df, *keys, text="text", chunks="chunks", labels=fixed.LABELS):
    """One column per label; a repeated label keeps its last chunk."""
    columns = [sx.last_chunk_of(chunks, label).alias(label) for label in labels]
    return df.select(*keys, text, *columns)
