"""Records to labelled text. Every step is a projection: no row is moved."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from labelweave.config import PRESETS
from labelweave.functions.binding import unfold
from labelweave.functions import labels as lx
from labelweave.functions import orders as ox


def with_order(df, key, augmentation=PRESETS["none"], template=None, name="order"):
    """A disturbed order per row: shuffle, then duplicate, then delete.

    The edits act on the whole template, before absent labels leave it, so
    many of them touch labels the record does not have.
    """
    a = augmentation
    order = (ox.template(key, a.profile, a.seed) if template is None
             else ox.fixed_template(template, a.profile))
    df = df.withColumn(name, order)
    if a.shuffle > 0:
        df = df.withColumn(name, ox.shuffled(name, key, a.shuffle, a.seed))
    if a.duplicate > 0:
        count = ox.duplications(name, key, a.duplicate, a.profile, a.seed)
        df = df.withColumn("_count", count)
        df = df.withColumn(name, ox.duplicated(name, key, "_count", a.seed)).drop("_count")
    if a.delete > 0:
        df = df.withColumn("_count", ox.deletions(name, key, a.delete, a.seed))
        df = df.withColumn(name, ox.shortened(name, key, "_count", a.seed)).drop("_count")
    return df


def label_records(df, fields="fields", order="order", tag_mode="position", text_mode="tokens"):
    """Adds ``text`` and ``tokens``, an array of (token, tag) structs.

    ``tag_mode="by_token"`` looks tags up by token text, the last one winning.
    ``text_mode="raw"`` joins the raw values, so doubled blanks survive.
    """
    df = df.withColumn("_parts", ox.parts(order, fields))
    df = df.withColumn("tokens", lx.bio_tokens(lx.part_words(F.col("_parts"))))
    if tag_mode == "by_token":
        df = df.withColumn("tokens", lx.tags_by_token("tokens"))
    text = (lx.address_text(F.col("_parts")) if text_mode == "raw"
            else lx.token_text(F.col("tokens.token")))
    return df.withColumn("text", text).drop("_parts")


def label_pairs(df, pairs="pairs", order="order", tag_mode="by_token"):
    """The list form: per label of the order the first pair of that label."""
    df = df.withColumn("_parts", ox.first_matches(order, pairs))
    df = df.withColumn("text", lx.address_text(F.col("_parts")))
    df = df.withColumn("tokens", lx.bio_tokens(lx.part_words(F.col("_parts")))).drop("_parts")
    if tag_mode == "by_token":
        df = df.withColumn("tokens", lx.tags_by_token("tokens"))
    return df


def annotate(df, tokens="tokens", name="label"):
    """Annotation structs with running offsets, for rows of any length."""
    df = df.withColumn("_starts", lx.running_starts(f"{tokens}.token"))
    return df.withColumn(name, lx.annotations(F.col(tokens), F.col("_starts"))).drop("_starts")


def cast_label(df, name="label"):
    """Stored annotations to the map and float form, as a plain projection."""
    return df.withColumn(name, lx.cast_annotations(F.col(name)))


def annotation_rows(df, *keys, label="label"):
    """One row per annotation: position, token, tag and offsets."""
    listed = unfold(df, keys, label, value="a")
    return listed.select(*keys, "pos", F.col("a.metadata.word").alias("token"),
                         F.col("a.result").alias("tag"),
                         F.col("a.begin").cast("bigint").alias("begin"),
                         F.col("a.end").cast("bigint").alias("end"))


def offset_rows(df, key, words="words"):
    """One row per word of rows with very many: position, token and offsets in the
    blank-joined text. The words of 256 rows are reckoned at once, as numbers."""
    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch.slice(at, 256)
                some = some.filter(some.column(1).is_valid())
                token = some.column(1).flatten()
                sizes = np.diff(some.column(1).offsets.to_numpy())
                ends = np.cumsum(pc.utf8_length(token).to_numpy().astype(np.int64) + 1)
                begin = np.concatenate([np.zeros(1, np.int64), ends])
                first = np.cumsum(sizes) - sizes
                base, start = np.repeat(begin[first], sizes), np.repeat(first, sizes)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                     pa.array(np.arange(len(token)) - start), token, pa.array(begin[:-1] - base),
                     pa.array(ends - base - 2)], [key, "pos", "token", "begin", "end"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, words).mapInArrow(run, f"`{key}` {kind}, pos long, token string, begin long, end long")


def token_rows(df, *keys, tokens="tokens"):
    """One row per labelled token."""
    listed = unfold(df, keys, tokens, value="t")
    return listed.select(*keys, "pos", "t.token", "t.tag")


def plain_format(df, columns, display):
    """Text, words and tags of a fixed list of columns, doubled blanks kept."""
    values = [F.col(name) for name in columns]
    tags = [lx.tags_from_count(lx.blank_split_count(value), label)
            for value, label in zip(values, display)]
    return df.withColumns({
        "text": lx.plain_text(values),
        "words": lx.plain_tokens(values),
        "tags": F.concat(*tags),
    })
