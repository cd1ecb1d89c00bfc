"""Splits, samples, shuffles, limits and row numbers."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from labelweave import fixed
from labelweave.functions import draws
from labelweave.session import materialise


def with_split(df, key, share=fixed.TRAIN_SHARE, seed=0, name="split"):
    """``train`` or ``test`` per row, decided by the row's own draw."""
    hit = draws.uniform(key, "split", seed=seed) < share
    return df.withColumn(name, F.when(hit, "train").otherwise("test"))


def with_validation(df, key, share=fixed.TRAIN_SHARE, validation=fixed.VALIDATION_SHARE,
                    seed=0, name="split"):
    """A third value: part of the training rows is held out for validation."""
    df = with_split(df, key, share, seed, name)
    held_out = draws.uniform(key, "validation", seed=seed) < validation
    return df.withColumn(name, F.when((F.col(name) == "train") & held_out, "validation")
                         .otherwise(F.col(name)))


def seeded_split(df, weights=(0.8, 0.2), seed=fixed.SPLIT_SEED):
    """Spark's own random split; its outcome depends on the partitioning."""
    return df.randomSplit(list(weights), seed)


def sample_rows(df, key, fraction, seed=0):
    """Rows kept independently of each other with the given probability.

    The filter depends on the key only, so Catalyst moves it below projections.
    """
    return df.filter(draws.uniform(key, "sample", seed=seed) < fraction)


def take_first(df, key, count):
    """The first rows in key order."""
    return df.orderBy(key).limit(count)


def with_row_index(df, order, by=(), name="row_index"):
    """Consecutive numbers from 0 in the given order, per group if ``by`` is set.

    The order must be total. Rows are range-partitioned over it, written once
    with their place in their partition, and the partition offsets are added.
    No task sees more than one range, so a group may hold most of the rows.
    The written table keeps ranges and places fixed even when tasks are
    repeated. Offsets are one row per range, plus one per further group in it;
    they are written too, so that Catalyst knows their size when it decides
    between a broadcast and a shuffled join.
    """
    columns = [*by, *order]
    ranged = (df.repartitionByRange(*columns).sortWithinPartitions(*columns)
              .withColumn("_slice", F.spark_partition_id())
              .withColumn("_place", F.monotonically_increasing_id()
                          .bitwiseAND(F.lit((1 << 33) - 1))))
    placed = materialise(ranged, "row-index")
    counts = placed.groupBy(*by, "_slice").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    before = (Window.partitionBy(*by).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *by, "_slice",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    numbered = placed.join(materialise(offsets, "row-offsets"), [*by, "_slice"])
    return numbered.select(*df.columns, (F.col("_place") + F.col("_offset")).alias(name))


def shuffle_rows(df, key, seed=0, name="position"):
    """Rows in random order, as a position per row."""
    drawn = df.withColumn("_draw", draws.uniform(key, "row_order", seed=seed))
    return with_row_index(drawn, ["_draw", key], name=name).drop("_draw")
