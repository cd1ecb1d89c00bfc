"""Frames over the given tables that the queries start from."""

from pyspark.sql import functions as F

from labelweave.functions import draws
from labelweave.functions import text as tx
from labelweave.operators import labelling as lab
from labelweave.operators import records as rec
from labelweave.session import spread

ADDRESS_COLUMNS = ("house_number", "road", "unit", "city", "state", "postcode")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_table(spark, sf_dir, name, *columns):
    """A table for costly row-wise work: read over all cores, even if small."""
    return spread(table(spark, sf_dir, name).select(*columns))


def addresses(spark, sf_dir):
    """Structured addresses: customers with their nation, region and a part name.

    Catalyst broadcasts nation and region by their known size and picks the
    join of customer and part by theirs.
    """
    c = wide_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part")
    joined = (c.join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey)
              .join(p, p.p_partkey == c.c_custkey, "left"))
    key = F.col("c_custkey")
    return joined.select(
        key.alias("key"),
        key.cast("string").alias("house_number"),
        F.col("p_name").alias("road"),
        F.when(key % 3 == 0, F.col("c_mktsegment")).alias("unit"),
        F.col("n_name").alias("city"),
        F.when(key % 4 != 0, F.col("r_name")).alias("state"),
        F.lpad(key.cast("string"), 5, "0").alias("postcode"))


def labelled(spark, sf_dir, augmentation=None, template=None, **modes):
    """Addresses with order, text and labelled tokens."""
    base = rec.with_fields(addresses(spark, sf_dir))
    settings = {} if augmentation is None else {"augmentation": augmentation}
    ordered = lab.with_order(base, "key", template=template, **settings)
    return lab.label_records(ordered, **modes)


def plain_labelled(spark, sf_dir):
    """Template 0, no augmentation: the base of most token queries."""
    return labelled(spark, sf_dir, template=0)


def tag_rows(spark, sf_dir):
    return lab.token_rows(plain_labelled(spark, sf_dir), "key")


ERROR_SHARE = 0.1


def predicted_rows(spark, sf_dir):
    """Token rows with a prediction that misses a tenth of the tags."""
    rows = tag_rows(spark, sf_dir)
    wrong = draws.uniform("key", "err", "pos") < ERROR_SHARE
    return rows.select("key", "pos", "token", F.col("tag").alias("target"),
                       F.when(wrong, "O").otherwise(F.col("tag")).alias("prediction"))


def predicted_tokens(spark, sf_dir):
    """The same, as an array of (token, predicted tag) per address."""
    wrong = f"{draws.uniform_text('key', 'err', 'pos')} < {ERROR_SHARE}"
    tagged = F.expr(f"transform(tokens, (t, pos) -> struct(t.token as token, "
                    f"if({wrong}, 'O', t.tag) as tag))")
    return plain_labelled(spark, sf_dir).select("key", "text", tagged.alias("tokens"))


def messages(spark, sf_dir):
    """Message text with handles, links and contractions around each document."""
    d = wide_table(spark, sf_dir, "documents", "doc_id", "text")
    marker = F.col("doc_id").cast("string")
    text = F.concat(F.lit("@user"), marker, F.lit(" Can't and WON'T "), F.col("text"),
                    F.lit(" https://t.example/"), marker, F.lit(" www.example.com/"), marker,
                    F.lit(" It's not"))
    return d.select("doc_id", text.alias("text"))


def labelled_documents(spark, sf_dir):
    """Documents with a sentiment: the quality label."""
    d = wide_table(spark, sf_dir, "documents", "doc_id", "text")
    q = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string")
                                              .alias("sentiment"))
    return d.join(q, "doc_id")


def document_words(spark, sf_dir):
    d = wide_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", tx.message_words(tx.clean_message(F.col("text"))).alias("words"))
