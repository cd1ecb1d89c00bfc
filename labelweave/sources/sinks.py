"""Writers. Each leaves one file per task; nothing is gathered unless asked for."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import labels as lx


def write_corpus(df, path, mode="append"):
    """Text, annotations and split as parquet, one folder per split."""
    df.select("text", "label", "split").write.mode(mode).partitionBy("split").parquet(path)


def write_parquet(df, path):
    df.write.mode("overwrite").parquet(path)


def conll_blocks(df, tokens="tokens", pos=None, keep=()):
    """One CoNLL block per row. ``pos`` is SQL text for the array of part-of-speech
    tags, by default the same tag for all."""
    tags = F.expr(pos or f"transform({tokens}, t -> '{fixed.DEFAULT_POS}')")
    return df.select(*keep, lx.conll_lines(F.col(tokens), tags).alias("block"))


def _document(block, docstart):
    head = F.lit(f"{fixed.DOCSTART}\n\n")
    if docstart == "before":
        return F.concat(head, block)
    # Behind every document, and once in front of the first row of a file.
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lead = F.when(in_task == 0, head).otherwise("")
    return F.concat(lead, block, F.lit(f"\n{fixed.DOCSTART}\n"))


def write_conll(blocks, path, docstart="before", mode="append", by=()):
    """CoNLL text. The sink ends every row with a line end, which makes the
    blank line between documents."""
    if by and docstart != "before":
        raise ValueError("a header behind the documents needs one file per task")
    text = blocks.select(*by, _document(F.col("block"), docstart).alias("value"))
    writer = text.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).text(path)


def write_lines(df, path, column="text", mode="append"):
    """One text per line."""
    df.select(column).write.mode(mode).text(path)


def write_predictions(df, path, single_file=False):
    """Predictions as CSV with header; one file only where that is wanted."""
    columns = df.select("sentiment", "text", "label", "prediction")
    out = columns.coalesce(1) if single_file else columns
    out.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_records(df, path, mode="errorifexists"):
    """Tagged records as CSV without header."""
    df.write.mode(mode).option("escape", '"').csv(path)


def write_concatenated(ranked, path):
    """Corpora end to end: files in rank, name and block order; blocks without
    a line are left out."""
    block = F.trim("value", F.lit("\n"))
    ordered = ranked.filter(F.trim(block) != "").orderBy("source_rank", "path", "block_start", "doc_no")
    ordered.select(F.concat(block, F.lit("\n")).alias("value")).write.text(path)


def save_model(model, path):
    model.write().overwrite().save(path)
