"""Expressions and readers that several operators share."""

from pyspark.sql import functions as F

# Fixed by the contracts: what separates words, as Spark and DuckDB both read it.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col="text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def word_array(text):
    """Words of a text in order; a text of blanks only has none."""
    return F.array_remove(F.split(text, BLANKS), "")


def word_count(text):
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold(doc_id, folds):
    """The held-out fold of a document: crc32 of its number written as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def let(value, body):
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(df, needed):
    """``df`` with all but the needed columns folded into one, and a function that
    unfolds them again, in the old order: whatever an operator calls its own
    columns, none of the input's is lost or taken for one of them."""
    rest = [c for c in df.columns if c not in needed]
    column = lambda c: F.col(f"`{c}`")
    inner = df.select(*needed, *[F.struct(*map(column, rest)).alias("__rest")][:len(rest)])

    def unfold(out):
        return out.select(*[F.col(c) if c in needed else F.col("__rest").getField(c).alias(c) for c in df.columns])
    return inner, unfold
