"""Labelled corpus to a fitted tagger, its scores, and wide records of new text."""

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import draws
from labelweave.functions import text as tx
from labelweave.functions.binding import unfold
from labelweave.operators import labelling as lab
from labelweave.operators import tagger as tg
from labelweave.operators import tokens as tok
from labelweave.operators import wide
from labelweave.session import materialise
from labelweave.sources import sinks


def format_corpus(df):
    """Stored annotations to tokens; texts of several sentences are left out."""
    cast = tok.with_sentences(lab.cast_label(df))
    single = tok.single_sentence_rows(cast).drop("sentences")
    return single.withColumn("tokens", F.transform("label", lambda a: F.struct(
        a["metadata"]["word"].alias("token"), a["result"].alias("tag"))))


@dataclass
class Tagger:
    """Emission model and tag order."""

    model: PipelineModel
    start: np.ndarray
    moves: np.ndarray

    @property
    def names(self):
        return tg.tag_names(self.model)

    def save(self, spark, path):
        sinks.save_model(self.model, f"{path}/emission")
        rows = [(i, [float(x) for x in row])
                for i, row in enumerate([self.start, *self.moves])]
        spark.createDataFrame(rows, "row int, scores array<double>").write.mode(
            "overwrite").parquet(f"{path}/order")

    @classmethod
    def load(cls, spark, path):
        rows = spark.read.parquet(f"{path}/order").orderBy("row").collect()
        scores = np.array([row["scores"] for row in rows])
        return cls(PipelineModel.load(f"{path}/emission"), scores[0], scores[1:])


def train(df, key="key", **settings):
    """Fits a tagger on rows with a key and an array of (token, tag). The features
    are written once for the passes over them."""
    rows = materialise(tg.context_rows(df, key), "features")
    model = tg.fit_tagger(rows, **settings)
    counts = tg.transition_counts(df, "tokens.tag")
    start, moves = tg.transition_matrix(counts, tg.tag_names(model))
    return Tagger(model, start, moves)


GRID = ({"reg": 1e-4, "max_iter": 20}, {"reg": 1e-2, "max_iter": 20}, {"reg": 1e-4, "max_iter": 5})


def train_selected(df, key="key", grid=GRID, seed=0):
    """(tagger, settings, scores): of the settings in ``grid`` the one that tags
    most tokens right in the validation rows, the first of equals, fitted again on
    all rows. ``scores`` has a dictionary per setting, with its ``accuracy``, the
    ``right`` tokens and all ``tokens`` validated.

    Validation rows are a hash draw of the key: the same on every run. With none of
    them, or none to learn from, the first setting is taken.
    """
    known = materialise(df.withColumn("_held", draws.uniform(key, "validation", seed=seed) < fixed.VALIDATION_SHARE), "split")
    learn, held = known.where("not _held").drop("_held"), known.where("_held").drop("_held")
    scores = []
    for setting in grid if learn.limit(1).count() and held.limit(1).count() else ():
        tagged = tag_texts(train(learn, key, **setting), held.select(key, "tokens"), truth="tag")
        right = F.size(F.filter("tokens", lambda t: t.tag.eqNullSafe(t.target)))
        row = tagged.agg(F.coalesce(F.sum(right), F.lit(0)).alias("right"),
                         F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("tokens")).first()
        scores.append({**setting, "right": row["right"], "tokens": row["tokens"],
                       "accuracy": row["right"] / row["tokens"] if row["tokens"] else 0.0})
    best = max(range(len(scores)), key=lambda i: (scores[i]["right"], -i)) if scores else 0
    return train(df, key, **grid[best]), dict(grid[best]), scores


def with_tagged_tokens(df, emissions, names, start, moves, truth=None):
    """All rows of ``df``, their ``tokens`` tagged along the best path.

    ``emissions`` turns context rows into rows with ``probabilities``. A row's
    identity is a number that is written with it: equal texts stay apart, and
    none gathers more than its own tokens. A row without tokens keeps none; all
    other columns stay.
    """
    held = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    scored = emissions(tg.context_rows(held.select("_row", "tokens"), "_row", tag=truth))
    tagged = tg.decode_rows(scored, ["_row"], names, start, moves, truth)
    joined = held.drop("tokens").join(tagged, "_row", "left")
    nothing = F.array().cast(tagged.schema["tokens"].dataType)
    return joined.withColumn("tokens", F.coalesce("tokens", nothing)).drop("_row")


def tag_texts(tagger, df, truth=None):
    """Rows with ``tokens`` to the same rows with tagged tokens, each with the
    probability of its tag; ``df`` may be a stream.

    Tokens need no tags; with ``truth="tag"`` those they have are kept beside
    the predicted ones.
    """
    return tg.tag_in_place(df, tg.Weights(tagger.model), tagger.names, tagger.start, tagger.moves, truth)


def score(tagger, df, key="key"):
    """Token rows with truth, prediction and the probability of the prediction."""
    rows = unfold(tag_texts(tagger, df.select(key, "tokens"), truth="tag"), [key], "tokens")
    return rows.select(key, "pos", "item.token", "item.target",
                       F.col("item.tag").alias("prediction"), "item.confidence")


def tokenise_texts(df, text="text"):
    """Free text with its tokens, over all its sentences; every row stays."""
    words = F.transform(tx.tokens(F.coalesce(F.col(text), F.lit(""))),
                        lambda token: F.struct(token.alias("token")))
    return df.withColumn("tokens", words)


def records_of(tagged, *keys, text="text", labels=fixed.LABELS, mode="glue"):
    """Keys, original text and a column per label of every tagged row."""
    return wide.wide_record(wide.with_chunks(tagged, mode=mode), *keys, text=text, labels=labels)


def extract_records(tagger, df, *keys, text="text", labels=fixed.LABELS, mode="glue"):
    """One wide record per row of free text: its keys, the text as it was, and a
    column per label. Empty and null texts give a record without labels."""
    tagged = tag_texts(tagger, tokenise_texts(df.select(*keys, text), text))
    return records_of(tagged, *keys, text=text, labels=labels, mode=mode)
