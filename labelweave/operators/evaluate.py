"""Scores of predicted tags, each as one pass over the token rows."""

from pyspark.sql import functions as F


def side_by_side(df, *keys, tokens="tokens", targets="targets", predictions="predictions"):
    """Token, truth and prediction, one row each; short arrays are padded."""
    zipped = F.arrays_zip(F.col(tokens).alias("token"), F.col(targets).alias("target"),
                          F.col(predictions).alias("prediction"))
    rows = df.select(*keys, F.posexplode(zipped).alias("pos", "row"))
    return rows.select(*keys, F.col("pos").cast("bigint").alias("pos"), "row.*")


def _is_right(target, prediction):
    return F.coalesce((F.col(target) == F.col(prediction)).cast("int"), F.lit(0))


def accuracy(df, target="target", prediction="prediction", scale=1.0):
    """Share of right rows; padded rows count as wrong."""
    right = _is_right(target, prediction)
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.sum(right).cast("bigint").alias("correct"),
                  (F.avg(right) * scale).alias("accuracy"))


def token_accuracy(df, target="target", prediction="prediction"):
    return accuracy(df, target, prediction, scale=100.0)


def confusion(df, target="target", prediction="prediction"):
    """Counts per pair of classes."""
    return df.groupBy(F.col(target).alias("target"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def _ratio(part, whole):
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def _f1(precision, recall):
    both = F.col(precision) + F.col(recall)
    return F.coalesce(F.try_divide(2 * F.col(precision) * F.col(recall), both), F.lit(0.0))


def class_scores(df, target="target", prediction="prediction"):
    """Precision, recall, F1 and support per class."""
    counts = confusion(df, target, prediction)
    hit = F.when(F.col("target") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("target").alias("class"), F.col("n").alias("support"),
                 zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("hits")))
    sums = (counts.select(F.inline(sides)).filter(F.col("class").isNotNull())
            .groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")]))
    scored = sums.withColumns({"precision": _ratio("hits", "predicted"),
                               "recall": _ratio("hits", "support")})
    return scored.withColumn("f1", _f1("precision", "recall")).select(
        "class", "precision", "recall", "f1", "support")


def classification_report(df, target="target", prediction="prediction"):
    """Class scores with the overall rows: accuracy, macro and weighted averages."""
    counts = confusion(df, target, prediction)
    scores = class_scores(df, target, prediction)
    names = ("precision", "recall", "f1")
    support = F.sum("support").alias("support")
    macro = scores.agg(*[F.avg(c).alias(c) for c in names], support)
    weighted = scores.agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
        support)
    hits = F.sum(F.when(F.col("target") == F.col("prediction"), F.col("n")).otherwise(0))
    overall = counts.agg((hits / F.sum("n")).alias("accuracy"), F.sum("n").alias("support"))
    overall = overall.select(*[F.col("accuracy").alias(c) for c in names], "support")
    order = ["class", *names, "support"]
    return (scores.select(*order)
            .unionByName(overall.select(F.lit("accuracy").alias("class"), *order[1:]))
            .unionByName(macro.select(F.lit("macro avg").alias("class"), *order[1:]))
            .unionByName(weighted.select(F.lit("weighted avg").alias("class"), *order[1:])))


def micro_scores(df, target="target", prediction="prediction", outside=("O",), dummies=(),
                 word_start=None):
    """Micro precision, recall and F1 without the outside class.

    Rows whose truth is a dummy class, or that do not start a word, are left out.
    """
    if word_start is not None:
        df = df.filter(F.col(word_start))
    if dummies:
        df = df.filter(~F.col(target).isin(*dummies))
    said = ~F.col(prediction).isin(*outside)
    meant = ~F.col(target).isin(*outside)

    def total(condition):
        return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")

    sums = df.agg(total(said & meant & (F.col(target) == F.col(prediction))).alias("hits"),
                  total(said).alias("predicted"), total(meant).alias("relevant"))
    scored = sums.withColumns({"precision": _ratio("hits", "predicted"),
                               "recall": _ratio("hits", "relevant")})
    return scored.withColumn("f1", _f1("precision", "recall"))
