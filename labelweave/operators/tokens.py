"""Documents to sentences and tokens, lexicons, dictionaries and encodings."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import text as tx
from labelweave.functions.binding import unfold
from labelweave.operators import subwords as sw
from labelweave.operators.sampling import with_row_index
from labelweave.session import materialise


def with_document(df, text="text", name="document"):
    return df.withColumn(name, tx.document(F.col(text)))


def with_sentences(df, text="text", name="sentences"):
    return df.withColumn(name, tx.sentences(F.col(text)))


def single_sentence_rows(df, sentences="sentences"):
    """Rows of at most one sentence; a row without text counts as none."""
    return df.filter(F.coalesce(F.size(sentences), F.lit(0)) <= 1)


def sentence_rows(df, *keys, sentences="sentences"):
    return unfold(df, keys, sentences, "sentence_no", "sentence")


def sentence_token_rows(df, *keys, sentence="sentence"):
    rows = df.select(*keys, F.posexplode(tx.tokens(F.col(sentence))).alias("pos", "token"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


# --- most-frequent-tag lexicon ------------------------------------------------

def fit_lexicon(df, token="token", tag="tag"):
    """The most frequent tag of every token; the smaller tag wins a tie.

    Counts are combined before they are moved, so a hot token costs one row
    per task.
    """
    counts = df.groupBy(F.col(token).alias("token"), F.col(tag).alias("tag")).agg(
        F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("tag").alias("tag")))
    return counts.groupBy("token").agg(best.alias("best")).select(
        "token", F.col("best.tag").alias("pos_tag"))


def apply_lexicon(df, lexicon, token="token", default=fixed.DEFAULT_POS, name="pos_tag"):
    """Tag of every token row, the default where the lexicon has none.

    The lexicon is written first: a join straight to its aggregate could not be
    split at run time. Written, it is broadcast if small enough, and else hot
    tokens of the sort-merge join are split.
    """
    known = materialise(lexicon, "lexicon").select(F.col("token").alias(token), F.col("pos_tag").alias(name))
    joined = df.join(known, token, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def _suffix_rows(df, longest, *keep):
    """Every row with the endings of its token, of up to ``longest`` characters,
    in lower case: the empty one first."""
    word = F.lower(F.col("token"))
    endings = F.transform(F.sequence(F.lit(0), F.least(F.lit(longest), F.char_length(word))), lambda k: F.right(word, k))
    return df.select(*keep, F.explode(endings).alias("suffix"))


def fit_suffixes(df, token="token", tag="tag", longest=4, least=2):
    """The tag that most different tokens of an ending have, for every ending that
    at least ``least`` tokens have; the smaller tag wins a tie. A suffix tree as a
    table: the empty ending stands for all tokens.

    A token counts once for each of its tags, so frequent words, which are not
    like unknown ones, do not outweigh the others. Counts are combined before they
    are moved.
    """
    kinds = df.select(F.col(token).alias("token"), F.col(tag).alias("tag")).where("token <> '' and tag is not null").distinct()
    counts = _suffix_rows(kinds, longest, "tag").groupBy("suffix", "tag").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("tag").alias("tag")))
    return (counts.groupBy("suffix").agg(best.alias("best"), F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("suffix") == ""))
            .select("suffix", "n", F.col("best.tag").alias("pos_tag")))


def guess_tags(df, lexicon, suffixes, longest=4, token="token"):
    """token and pos_tag of every different token of ``df`` that the lexicon does
    not know, by its longest ending in ``suffixes``; shorter ones stand in, down to
    the empty one. Null and empty tokens are left out."""
    unknown = df.select(F.col(token).alias("token")).where("token <> ''").distinct().join(
        lexicon.select("token"), "token", "left_anti")
    met = _suffix_rows(unknown, longest, "token").join(materialise(suffixes, "suffixes"), "suffix")
    longest_met = F.max_by("pos_tag", F.char_length("suffix"))
    return met.groupBy("token").agg(longest_met.alias("pos_tag"))


def extend_lexicon(df, lexicon, suffixes, longest=4, token="token"):
    """The lexicon with a guess for every token of ``df`` that it does not know."""
    lexicon = materialise(lexicon, "lexicon")
    return lexicon.unionByName(guess_tags(df, lexicon, suffixes, longest, token))


# --- dictionaries ---------------------------------------------------------------

def tag_dictionary(df, document, position, tag="tag", outside=fixed.OUTSIDE_TAG):
    """Tag ids by first appearance; the outside tag is always 0. The list to be
    numbered has a row per tag."""
    first = df.filter(F.col(tag) != outside).groupBy(F.col(tag).alias("tag")).agg(
        F.min(F.struct(document, position)).alias("_first"))
    number = F.row_number().over(Window.orderBy("_first", "tag"))
    ids = first.select("tag", number.cast("bigint").alias("tag_id"))
    zero = df.sparkSession.createDataFrame([(outside, 0)], "tag string, tag_id bigint")
    return zero.unionByName(ids)


def with_tag_ids(df, dictionary, tag="tag"):
    return df.join(dictionary.withColumnRenamed("tag", tag), tag, "left")


def encode_pieces(df, *keys, token="token", tag="tag", width=4):
    """Piece rows with word-start flag and normalised text."""
    rows = df.select(*keys, F.posexplode(
        tx.pieces(F.col(token), F.col(tag), width)).alias("piece_no", "p"))
    return rows.select(*keys, F.col("piece_no").cast("bigint").alias("piece_no"), "p.*")


def encode_learned(df, *keys, pattern, token="token", tag="tag"):
    """Piece rows of words cut by ``subwords.prefix_pattern`` of a learned vocabulary."""
    rows = df.select(*keys, F.posexplode(
        tx.marked_pieces(sw.cut(F.col(token), pattern), F.col(tag))).alias("piece_no", "p"))
    return rows.select(*keys, F.col("piece_no").cast("bigint").alias("piece_no"), "p.*")


def word_starts(df, flag="is_word_start"):
    """Only the first piece of each word: one row per word again."""
    return df.filter(F.col(flag))


# --- corpus profile ---------------------------------------------------------------

def character_set(df, text="text"):
    """Distinct characters; repeats leave each row before anything is moved."""
    chars = df.select(F.explode(F.array_distinct(F.split(text, ""))).alias("character"))
    return chars.filter(F.col("character") != "").distinct()


def tag_set(df, tag="tag"):
    return df.select(tag).distinct()


def corpus_profile(tokens, vectors, tag="tag", token="token", vector="embedding"):
    """Number of tags, width of the vectors and number of characters."""
    n_tags = tag_set(tokens, tag).agg(F.count(F.lit(1)).alias("value"))
    width = vectors.agg(F.max(F.size(vector)).cast("bigint").alias("value"))
    n_chars = character_set(tokens, token).agg(F.count(F.lit(1)).alias("value"))
    named = [(n_tags, "n_tags"), (width, "embedding_width"), (n_chars, "n_characters")]
    profile = None
    for frame, name in named:
        row = frame.select(F.lit(name).alias("name"), "value")
        profile = row if profile is None else profile.unionByName(row)
    return profile


# --- batches -----------------------------------------------------------------------

def length_bucket(length, limits=fixed.LENGTH_BUCKETS):
    """Number of the first limit the length fits, one more beyond the last."""
    chain = F.when(length <= limits[0], 0)
    for number, limit in enumerate(limits[1:], start=1):
        chain = chain.when(length <= limit, number)
    return chain.otherwise(len(limits)).cast("bigint")


def with_batches(df, key, bucket, size):
    """Fixed-size batches inside each bucket in key order, the rest last.

    Numbering is range-partitioned, so a bucket may hold most of the rows.
    """
    numbered = with_row_index(df, [key], by=[bucket], name="_number")
    batch = F.floor(F.col("_number") / size).cast("bigint")
    return numbered.withColumn("batch", batch).drop("_number")


def pad_to_batch(df, batch_keys, column, fill=0):
    """Arrays padded with ``fill`` to the longest of their batch.

    A batch is of fixed size, so its window is small; rows are moved once.
    """
    batch = Window.partitionBy(*batch_keys)
    wide = df.withColumn("_longest", F.max(F.size(column)).over(batch))
    element = df.schema[column].dataType.elementType
    padding = F.array_repeat(F.lit(fill).cast(element), F.col("_longest") - F.size(column))
    return wide.withColumn(column, F.concat(column, padding)).drop("_longest")


def pad_nested_to_batch(df, batch_keys, column, fill=0):
    """Arrays of arrays padded in both directions: inner ones to the longest
    inner, outer ones with rows of ``fill``."""
    batch = Window.partitionBy(*batch_keys)
    inner_size = F.array_max(F.transform(column, lambda inner: F.size(inner)))
    wide = df.withColumns({"_outer": F.max(F.size(column)).over(batch),
                           "_inner": F.max(inner_size).over(batch)})
    element = df.schema[column].dataType.elementType.elementType
    value = F.lit(fill).cast(element)
    inner = F.transform(column, lambda x: F.concat(
        x, F.array_repeat(value, F.col("_inner") - F.size(x))))
    missing = F.array_repeat(F.array_repeat(value, F.col("_inner")),
                             F.col("_outer") - F.size(column))
    return wide.withColumn(column, F.concat(inner, missing)).drop("_outer", "_inner")
