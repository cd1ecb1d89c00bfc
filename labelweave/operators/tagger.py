"""Token tagging: context features, a multinomial model, tag order and decoding."""

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, StringIndexer, StringIndexerModel, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelweave.functions.binding import let
from labelweave.session import materialise, ship_package

START = "<start>"
END = "<end>"
FEATURES = ("word", "shape", "prefix", "suffix", "previous", "next", "place")


# --- features --------------------------------------------------------------------

def _shape(token):
    return (f"regexp_replace(regexp_replace(regexp_replace({token}, '[A-Z]+', 'X'), "
            "'[a-z]+', 'x'), '[0-9]+', '9')")


def context_items(tokens="tokens", tag="tag"):
    """SQL of the categorical features per token, as an array of structs.
    Neighbours come from the row's own array."""
    word = "lower(trim({}.token))"
    previous = f"coalesce({word.format('get(all, i - 1)')}, '{START}')"
    following = f"coalesce({word.format('get(all, i + 1)')}, '{END}')"
    has_tag = f"t.{tag} as tag, " if tag else ""
    item = (f"struct(cast(i as bigint) as pos, t.token as token, {has_tag}"
            f"{word.format('t')} as word, {_shape('t.token')} as shape, "
            "substring(lower(t.token), 1, 2) as prefix, "
            "right(lower(t.token), 2) as suffix, "
            f"{previous} as previous, {following} as next, "
            "case when i = 0 then 'first' when i = size(all) - 1 then 'last' "
            "else 'inner' end as place)")
    return let("all", tokens, f"transform(all, (t, i) -> {item})")


def context_rows(df, *keys, tokens="tokens", tag="tag"):
    """The features as a row per token; no row is moved."""
    return df.select(*keys, F.inline(F.expr(context_items(tokens, tag))))


def token_vectors(df, tokens="words", size=16, min_count=5, seed=0, partitions=None):
    """Word vectors fitted on the corpus at hand.

    The estimator trains in one partition unless told otherwise; here all cores
    take part. Words below ``min_count`` have no vector, which bounds the model.
    """
    partitions = partitions or df.sparkSession.sparkContext.defaultParallelism
    return Word2Vec(vectorSize=size, minCount=min_count, seed=seed, numPartitions=partitions,
                    inputCol=tokens, outputCol="vector").fit(df)


# --- emission model ------------------------------------------------------------------

def fit_tagger(rows, features=FEATURES, buckets=1 << 14, max_iter=20, reg=1e-4):
    """``rows`` has the feature columns and ``tag``.

    Features are hashed, so the model size does not grow with the vocabulary,
    and every gradient step is one distributed aggregate.
    """
    stages = [
        StringIndexer(inputCol="tag", outputCol="label"),
        FeatureHasher(inputCols=list(features), outputCol="features", numFeatures=buckets,
                      categoricalCols=list(features)),
        LogisticRegression(maxIter=max_iter, regParam=reg, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(rows)


def tag_names(model):
    """Tags in index order."""
    indexer = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    return list(indexer.labels)


def scored_rows(model, rows):
    """Token rows with the probability of every tag."""
    stages = [s for s in model.stages if not isinstance(s, StringIndexerModel)]
    scored = rows
    for stage in stages:
        scored = stage.transform(scored)
    return scored.withColumn("probabilities", vector_to_array("probability")).drop(
        "features", "rawPrediction", "probability", "prediction")


def with_best_tag(df, names, name="prediction"):
    """Most probable tag and its confidence."""
    tags = F.array(*[F.lit(tag) for tag in names])
    place = F.expr(let("p_", "probabilities", "array_position(p_, array_max(p_))"))
    return df.withColumns({name: F.element_at(tags, place.cast("int")),
                           "confidence": F.array_max("probabilities")})


def softmax(scores, threshold=None):
    """Probabilities of a score array; those below the threshold become 0."""
    shifted = let("s_", scores, let("m_", "array_max(s_)", "transform(s_, x -> exp(x - m_))"))
    total = "aggregate(e_, 0D, (sum, x) -> sum + x)"
    kept = "x / total_" if threshold is None else (
        f"if(x / total_ >= {threshold}D, x / total_, 0D)")
    return F.expr(let("e_", shifted, let("total_", total, f"transform(e_, x -> {kept})")))


def count_emissions(rows, training, names, token="token", tag="tag"):
    """Add-one smoothed share of every tag among the uses of a token.

    A plain stand-in for a fitted emission model: one count table, joined to
    the token rows by token. It is written first, so that adaptive execution
    can split the rows of a hot token.
    """
    counts = training.groupBy(token, tag).agg(F.count(F.lit(1)).alias("n"))
    per_token = counts.groupBy(token).agg(
        F.map_from_entries(F.collect_list(F.struct(tag, "n"))).alias("_n"),
        F.sum("n").alias("_total"))
    tags = F.array(*[F.lit(name) for name in names])
    share = F.transform(tags, lambda name: (
        (F.coalesce(F.try_element_at("_n", name), F.lit(0)) + 1.0)
        / (F.coalesce("_total", F.lit(0)) + float(len(names)))))
    joined = rows.join(materialise(per_token, "emissions"), token, "left")
    return joined.withColumn("probabilities", share).drop("_n", "_total")


# --- tag order -----------------------------------------------------------------------

def transition_counts(df, tags):
    """How often one tag follows another; row starts follow the start mark.

    Pairs come from the row's own array. They are counted per task before they
    are moved, and at most tags squared rows come out.
    """
    pair = f"struct(coalesce(get(all, i - 1), '{START}') as previous, tag as tag)"
    pairs = F.expr(let("all", tags, f"transform(all, (tag, i) -> {pair})"))
    return df.select(F.inline(pairs)).groupBy("previous", "tag").agg(
        F.count(F.lit(1)).alias("n"))


def transition_scores(counts, n_tags):
    """Add-one smoothed log probability of each pair seen; a pair not seen
    scores like a count of zero."""
    total = F.sum("n").over(Window.partitionBy("previous"))  # at most one row per tag
    return counts.withColumn("total", total).withColumn(
        "log_probability", F.log((F.col("n") + 1.0) / (F.col("total") + float(n_tags))))


def transition_matrix(counts, names):
    """Start scores and a square matrix of transition scores, as numpy arrays.

    The rows collected are bounded by the square of the number of tags.
    """
    size = len(names)
    index = {tag: i for i, tag in enumerate(names)}
    seen = np.zeros((size + 1, size))
    for row in counts.collect():
        if row["tag"] in index and (row["previous"] == START or row["previous"] in index):
            seen[index.get(row["previous"], size), index[row["tag"]]] = row["n"]
    scores = np.log((seen + 1.0) / (seen.sum(axis=1, keepdims=True) + size))
    return scores[size], scores[:size]


def best_path(emissions, start, moves):
    """Most probable tag sequence of one row; ties go to the lower index."""
    score = start + emissions[0]
    back = np.zeros(emissions.shape, dtype=np.int32)
    for i in range(1, len(emissions)):
        through = score[:, None] + moves
        back[i] = through.argmax(axis=0)
        score = through.max(axis=0) + emissions[i]
    path = [int(score.argmax())]
    for i in range(len(emissions) - 1, 0, -1):
        path.append(int(back[i][path[-1]]))
    return path[::-1]


def best_paths(rows, start, moves):
    """Best paths of many rows at once, in groups of equal length."""
    lengths = np.array([len(r) for r in rows])
    out = [[] for _ in rows]
    for length in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == length)
        for part in np.array_split(at, -(-len(at) * length // 100_000)):
            emissions = np.array([np.stack(rows[i]) for i in part])
            score = start + emissions[:, 0]
            back = np.zeros(emissions.shape, np.int32)
            for i in range(1, length):
                through = score[:, :, None] + moves
                back[:, i] = through.argmax(axis=1)
                score = through.max(axis=1) + emissions[:, i]
            path = np.zeros((len(part), length), np.int32)
            path[:, -1] = score.argmax(axis=1)
            for i in range(length - 1, 0, -1):
                path[:, i - 1] = back[np.arange(len(part)), i, path[:, i]]
            for i, tags in zip(part, path):
                out[i] = tags
    return out


# --- scoring in place ----------------------------------------------------------------

_MUL = (np.uint32(0xCC9E2D51), np.uint32(0x1B873593), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def _rotl(x, r):
    return (x << np.uint32(r)) | (x >> np.uint32(32 - r))


def feature_buckets(texts, buckets, seed=42):
    """Bucket of every text, as Spark's FeatureHasher places it: 32-bit murmur3 of
    its bytes. All texts at once, four bytes a step."""
    data = [text.encode() for text in texts]
    lengths = np.array([len(d) for d in data], np.int64)
    width = int(lengths.max(initial=0)) // 4 * 4 + 4
    held = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in data), "<u4").reshape(len(data), width // 4)
    h = np.full(len(data), seed, np.uint32)
    mixed = lambda k: _rotl(k * _MUL[0], 15) * _MUL[1]
    for i in range(width // 4):
        whole = lengths >= 4 * (i + 1)
        tail = ~whole & (lengths > 4 * i)
        k = mixed(held[:, i])
        h = np.where(whole, _rotl(h ^ k, 13) * np.uint32(5) + np.uint32(0xE6546B64), np.where(tail, h ^ k, h))
    h ^= lengths.astype(np.uint32)
    h = (h ^ (h >> np.uint32(16))) * _MUL[2]
    h = (h ^ (h >> np.uint32(13))) * _MUL[3]
    h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64) % buckets


class Weights:
    """The regression of a fitted tagger as plain arrays: a row of ``table`` per
    bucket, a column per tag. Its size is fixed by buckets and tags."""

    def __init__(self, model):
        hasher = next(s for s in model.stages if isinstance(s, FeatureHasher))
        regression = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
        self.features, self.buckets = hasher.getInputCols(), hasher.getNumFeatures()
        self.table = np.ascontiguousarray(regression.coefficientMatrix.toArray().T)
        self.intercept = regression.interceptVector.toArray()

    def probabilities(self, rows):
        """Of every tag for all tokens of the rows, one after the other. A row is
        a list of (word, shape, prefix, suffix) of its tokens."""
        flat = [token for row in rows for token in row]
        held = {name: [token[i] for token in flat] for i, name in enumerate(FEATURES[:4])}
        held["previous"] = [w for row in rows for w in [START, *(token[0] for token in row)][:len(row)]]
        held["next"] = [w for row in rows for w in [*(token[0] for token in row[1:]), END][:len(row)]]
        held["place"] = [p for row in rows for p in (["first"] + ["inner"] * (len(row) - 2) + ["last"])[:len(row)]]
        margins = self.intercept
        for name in self.features:
            codes, distinct = pd.factorize(np.array(held[name], object))
            margins = margins + self.table[feature_buckets([f"{name}={v}" for v in distinct], self.buckets)[codes]]
        raised = np.exp(margins - margins.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)


def place_tagger(weights, start, moves):
    """A pandas function from the (word, shape, prefix, suffix) of a row's tokens to
    two arrays: the tag indices along its best path, and the probability of each."""
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def tag(items: pd.Series) -> pd.Series:
        rows = [[] if row is None else list(row) for row in items]
        if not any(rows):
            return pd.Series([[[], []] for _ in rows], dtype="object")
        probabilities = np.split(weights.probabilities(rows), np.cumsum([len(row) for row in rows])[:-1])
        paths = best_paths([np.log(np.maximum(p, 1e-12)) for p in probabilities], start, moves)
        return pd.Series([[np.asarray(path, float), p[np.arange(len(path)), path] if len(path) else np.zeros(0)]
                          for p, path in zip(probabilities, paths)], dtype="object")
    return tag


def tag_in_place(df, weights, names, start, moves, truth=None, tokens="tokens"):
    """Rows with ``tokens`` tagged where they lie: token, tag, the probability of
    the tag, and the ``truth`` field of the tokens as ``target``.

    Features, scores and the best path of a row come from the row alone, so
    nothing is exploded, moved or joined, and a stream can be tagged like a table.
    A row without tokens, or with null for them, keeps none.
    """
    ship_package(df.sparkSession)
    # Neighbours and places are looked up in Python: Spark leaves a function
    # alone whose arguments hold conditions.
    own = (f"transform({tokens}, t -> array(lower(trim(t.token)), {_shape('t.token')}, "
           "substring(lower(t.token), 1, 2), right(lower(t.token), 2)))")
    paths = df.withColumn("_path", place_tagger(weights, start, moves)(F.expr(own)))
    tags = F.array(*[F.lit(tag) for tag in names])

    def tagged(z):
        target = [z["item"][truth].alias("target")] if truth else []
        return F.struct(z["item"]["token"].alias("token"), F.get(tags, z["tag"].cast("int")).alias("tag"),
                        z["sure"].alias("confidence"), *target)

    zipped = F.arrays_zip(F.col(tokens).alias("item"), F.get("_path", F.lit(0)).alias("tag"),
                          F.get("_path", F.lit(1)).alias("sure"))
    listed = paths.withColumn(tokens, F.transform(zipped, tagged)).drop("_path")
    nothing = F.array().cast(listed.schema[tokens].dataType)
    return listed.withColumn(tokens, F.coalesce(tokens, nothing))


def decoder(start, moves):
    """A pandas function from arrays of log emission scores to tag indices."""
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def decode(emissions: pd.Series) -> pd.Series:
        return pd.Series(best_paths(list(emissions), start, moves), index=emissions.index)
    return decode


def decode_rows(df, keys, names, start, moves, truth=None):
    """Tags of every row of ``keys`` along its best path.

    Token rows come back together per source row; a group is never larger than
    one text. ``df`` has ``pos``, ``token`` and ``probabilities``; a ``truth``
    column is carried along as ``target``.
    """
    ship_package(df.sparkSession)
    kept = ["pos", "token", "probabilities"]
    kept += [F.col(truth).alias("target")] if truth else []
    listed = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*kept))).alias("items"))
    emissions = F.expr("transform(items.probabilities, "
                       "p -> transform(p, x -> ln(greatest(x, 1e-12D))))")
    paths = listed.withColumn("path", decoder(start, moves)(emissions))
    tags = F.array(*[F.lit(tag) for tag in names])

    def tagged(z):
        target = [z["item"]["target"].alias("target")] if truth else []
        return F.struct(z["item"]["token"].alias("token"),
                        F.get(tags, z["tag"]).alias("tag"), *target)

    zipped = F.arrays_zip(F.col("items").alias("item"), F.col("path").alias("tag"))
    return paths.select(*keys, F.transform(zipped, tagged).alias("tokens"))
