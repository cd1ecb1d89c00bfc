"""Text classification: cleaning, n-gram features, logistic regression."""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (IDF, CountVectorizerModel, NGram, StringIndexer, Tokenizer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import text as tx
from labelweave.functions.binding import let
from labelweave.session import materialise, ship_package

SIZES = tuple(range(1, fixed.MAX_NGRAM + 1))
_PART = 1 << 20  # words that are counted at once, about; a longer text is alone
_SENT = 1 << 17  # keys, at most, that are sent to the tasks


def with_clean_text(df, text="text", name="tweet"):
    return df.withColumn(name, tx.clean_message(F.col(text)))


def ngram_rows(df, *keys, words="words", sizes=SIZES):
    """One row per n-gram: ``n``, its place and the term."""
    def grams(n):
        return F.transform(tx.ngrams(words, n), lambda term, i: F.struct(
            F.lit(n).cast("bigint").alias("n"), i.cast("bigint").alias("pos"),
            term.alias("term")))

    return df.select(*keys, F.inline(F.flatten(F.array(*[grams(n) for n in sizes]))))


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coded(batch):
    """Of each part of a batch of about _PART words: the distinct words, and of all
    words in order their numbers and their rows."""
    rows = batch.column(0)
    rows = rows.filter(rows.is_valid())
    ends = np.cumsum(np.diff(rows.offsets.to_numpy()))
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PART, "right")))
        part = rows.slice(at, to - at)
        words = part.flatten().dictionary_encode()
        sizes = np.diff(part.offsets.to_numpy())
        yield (words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False).astype(np.int64),
               np.repeat(np.arange(len(sizes)), sizes))
        at = to


def _hashes(words, codes, rows, sizes):
    """n, the places at which an n-gram begins, and its 64-bit hash there."""
    of = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)[codes] if len(words) else np.empty(0, np.uint64)
    for n in sizes:
        count = max(0, len(codes) - n + 1)
        at = np.flatnonzero(rows[:count] == rows[len(rows) - count:])
        sums = np.full(len(at), n, np.uint64)
        for j in range(n):
            sums = _mixed(sums * np.uint64(0x9E3779B97F4A7C15) + of[at + j])
        yield n, at, sums.view(np.int64)


def hash_counts(df, words="words", sizes=SIZES):
    """n, hash (in the column ``term``) and count of n-grams, added up per task."""
    def run(batches):
        for batch in batches:
            for part in _coded(batch):
                for n, _, hashes in _hashes(*part, sizes):
                    terms, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(terms), n, np.int64)), pa.array(terms), pa.array(counts.astype(np.int64))],
                        ["n", "term", "count"])

    return df.select(words).mapInArrow(run, "n long, term long, count long")


def term_counts(df, words="words", sizes=SIZES, wanted=None):
    """n, hash, term, uses and rows that use it, added up per task, of the terms
    with the sorted hashes ``wanted`` of their n, or of all. Terms are told apart
    by their words, whatever their hashes."""
    def run(batches):
        for batch in batches:
            for names, codes, rows in _coded(batch):
                for n, at, hashes in _hashes(names, codes, rows, sizes):
                    if wanted is not None:
                        some = wanted.get(n, np.empty(0, np.int64))
                        place = np.minimum(np.searchsorted(some, hashes), max(0, len(some) - 1))
                        keep = some[place] == hashes if len(some) else np.zeros(len(hashes), bool)
                        at, hashes = at[keep], hashes[keep]
                    if not len(at):
                        continue
                    own = codes[at]
                    for j in range(1, n):
                        own = np.unique(own, return_inverse=True)[1] * len(names) + codes[at + j]
                    _, first, own, uses = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
                    docs = np.bincount(np.unique(own * (rows[-1] + 1) + rows[at]) // (rows[-1] + 1), minlength=len(first))
                    terms = [" ".join([names[c] for c in codes[i:i + n]]) for i in at[first].tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), n, np.int64)), pa.array(hashes[first]), pa.array(terms, pa.string()),
                         pa.array(uses.astype(np.int64)), pa.array(docs.astype(np.int64))],
                        ["n", "hash", "term", "uses", "docs"])

    return df.select(words).mapInArrow(run, "n long, hash long, term string, uses long, docs long")


def term_key(term):
    """The key of a term by the column of its hash: the hash itself."""
    return F.col(term)


def _thresholds(counted, size):
    """n and the count from which a key may be one of the ``size`` most frequent
    of its n, by the number of keys of every count."""
    levels = counted.groupBy("n", "count").agg(F.count(F.lit(1)).alias("keys"))
    above = F.sum("keys").over(Window.partitionBy("n").orderBy(F.desc("count")))
    reached = F.when(above >= size, F.col("count"))
    return levels.select("n", reached.alias("reached")).groupBy("n").agg(
        F.coalesce(F.max("reached"), F.lit(0)).alias("least"))


def vocabulary(df, words="words", size=fixed.VOCABULARY_SIZE, sizes=SIZES, doc_freq=False, key=term_key):
    """The most frequent terms per n, with their rank; ties go by term. ``doc_freq``
    adds the number of rows that use the term.

    Terms are counted by 64-bit keys first, made of their hashes, so that no string is
    moved for them; every task adds up the words of a batch as numbers. A
    key's count is at least that of each of its terms; terms are resolved and
    counted by themselves, in a second pass, where the key's count reaches that of
    the ``size``-th key. If terms that share a key have kept one out, that is, if
    the last term of a list is below this count, more keys are resolved. Up to
    _SENT keys go to the tasks, so that other terms are never written out.
    """
    ship_package(df.sparkSession)
    grams = hash_counts(df, words, sizes).select("n", key("term").alias("key"), "count")
    counted = materialise(grams.groupBy("n", "key").agg(F.sum("count").alias("count")), "keys")
    order, wanted = [F.desc("count"), F.asc("term")], size
    while True:
        least = materialise(_thresholds(counted, wanted), "least")
        kept = materialise(counted.join(least, "n").where("count >= least").select("n", "key"), "kept")
        sent = None
        if key is term_key and kept.count() <= _SENT:
            keys = kept.collect()
            sent = {n: np.sort(np.array([r["key"] for r in keys if r["n"] == n], np.int64)) for n in sizes}
        rows = term_counts(df, words, sizes, sent).withColumnRenamed("hash", "h")
        rows = rows.select("n", key("h").alias("key"), "term", "uses", "docs")
        counts = [F.sum("uses").alias("count")] + [F.sum("docs").alias("doc_freq")] * doc_freq
        terms = materialise(rows.join(kept, ["n", "key"]).groupBy("n", "term").agg(*counts), "terms")
        tops = None
        for n in sizes:
            top = terms.filter(F.col("n") == n).orderBy(*order).limit(size)
            # At most ``size`` rows are left here.
            ranked = top.withColumn("rank", (F.row_number().over(
                Window.partitionBy("n").orderBy(*order)) - 1).cast("bigint"))
            tops = ranked if tops is None else tops.unionByName(ranked)
        tops = materialise(tops, "vocabulary")
        short = (tops.groupBy("n").agg(F.min("count").alias("last"), F.count(F.lit(1)).alias("found"))
                 .join(least, "n").where(f"last < least or (found < {size} and least > 0)"))
        if not short.limit(1).count():
            return tops
        wanted *= 2


def inverse_document_frequency(n_docs, terms, min_doc_freq=fixed.MIN_DOC_FREQ):
    """Smoothed idf of vocabulary terms with their ``doc_freq``; 0 below the
    minimum document count."""
    idf = F.log(F.lit(n_docs + 1.0) / (F.col("doc_freq") + 1))
    return terms.select("n", "term", "doc_freq").withColumn(
        "idf", F.when(F.col("doc_freq") >= min_doc_freq, idf).otherwise(0.0))


def label_index(df, label):
    """Index of every label by frequency, the most frequent first, ties by name."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    number = F.row_number().over(Window.orderBy(F.desc("count"), "label")) - 1
    return counts.select("label", "count", number.cast("bigint").alias("index"))


def _fitted_counts(df, size):
    """Count vectorisers over the exact top terms, so that ties cannot change
    them between runs. Only the vocabulary reaches the driver: it is the model."""
    words = df.select(tx.message_words(F.col("tweet")).alias("words"))
    terms = {n: [] for n in SIZES}
    for row in vocabulary(words, size=size).orderBy("n", "rank").toLocalIterator():
        terms[row["n"]].append(row["term"])
    return [CountVectorizerModel.from_vocabulary(
        terms[n], inputCol=f"{n}_grams", outputCol=f"{n}_tf") for n in SIZES if terms[n]]


def build_stages(counts, label="sentiment"):
    """Words, n-grams, counts, one idf over all counts, and the label index."""
    ngrams = [NGram(n=n, inputCol="words", outputCol=f"{n}_grams") for n in SIZES]
    return [
        Tokenizer(inputCol="tweet", outputCol="words"), *ngrams, *counts,
        VectorAssembler(inputCols=[c.getOutputCol() for c in counts], outputCol="tf"),
        IDF(inputCol="tf", outputCol="features", minDocFreq=fixed.MIN_DOC_FREQ),
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="frequencyDesc"),
    ]


def fit_with_rows(df, label="sentiment", size=fixed.VOCABULARY_SIZE):
    """The model, and label and features of the rows it learned from. ``df`` has
    ``text`` and the label column.

    The cleaned text is written once for the vocabularies; the counts of a row are
    made once and written for document frequencies, label counts, the passes of the
    regression and whoever reads the rows.
    """
    cleaned = materialise(with_clean_text(df).select("tweet", label), "cleaned")
    *to_counts, idf, index = build_stages(_fitted_counts(cleaned, size), label)
    counted = materialise(PipelineModel(to_counts).transform(cleaned).select(label, "tf"), "counts")
    features = Pipeline(stages=[idf, index]).fit(counted)
    rows = features.transform(counted).select("label", "features")
    regression = LogisticRegression(maxIter=fixed.MAX_ITERATIONS).fit(rows)
    return PipelineModel([*to_counts, *features.stages, regression]), rows


def fit_classifier(df, label="sentiment", size=fixed.VOCABULARY_SIZE):
    return fit_with_rows(df, label, size)[0]


def classify(model, df):
    return model.transform(with_clean_text(df))


def margins(model):
    """A pandas function from a feature array to the margin of the fitted
    two-class regression, from its coefficients alone."""
    regression = model.stages[-1]
    weights, intercept = regression.coefficients.toArray(), float(regression.intercept)

    @F.pandas_udf("double")
    def margin(features: pd.Series) -> pd.Series:
        return pd.Series([float(np.dot(x, weights)) + intercept for x in features], dtype="float64")
    return margin


def feature_doc_freq(df, terms, words="words"):
    """Documents per vocabulary term, taken from the assembled count vectors."""
    listed = {n: [] for n in SIZES}
    for row in terms.orderBy("n", "rank").toLocalIterator():
        listed[row["n"]].append(row["term"])
    sizes = [n for n in SIZES if listed[n]]
    grams = [NGram(n=n, inputCol=words, outputCol=f"{n}_grams") for n in sizes]
    counts = [CountVectorizerModel.from_vocabulary(
        listed[n], inputCol=f"{n}_grams", outputCol=f"{n}_tf") for n in sizes]
    assembler = VectorAssembler(inputCols=[f"{n}_tf" for n in sizes], outputCol="tf")
    assembled = PipelineModel([*grams, *counts, assembler]).transform(df)
    totals = assembled.agg(Summarizer.numNonZeros(F.col("tf")).alias("nonzero"))
    features = totals.select(F.posexplode(vector_to_array("nonzero")).alias("feature", "doc_freq"))
    offsets = F.lit(0)
    for n in sizes:
        offsets = F.when(F.col("n") == n, sum(len(listed[m]) for m in sizes if m < n)
                         ).otherwise(offsets)
    placed = terms.withColumn("feature", (offsets + F.col("rank")).cast("int"))
    return placed.join(features, "feature").select(
        "n", "term", F.col("doc_freq").cast("bigint").alias("doc_freq"))


def load_classifier(path):
    return PipelineModel.load(path)
