"""Arrays without double work: naming a value, and unfolding a column to rows."""

from pyspark.sql import functions as F


def let(name, value, body):
    """SQL text of ``body`` with ``name`` standing for ``value``.

    The value is computed once per row. A plain column reference inside a
    lambda is not enough: the optimiser may move the column's own expression
    into the lambda, where it would run once per array element.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def unfold(df, keys, column, pos="pos", value="item"):
    """One row per element of an array column, with its position.

    For a plain ``posexplode`` of a computed column Catalyst infers a filter on
    its size and computes the column once more for it, further down the plan.
    The outer form infers none; the rows of empty arrays it adds are dropped.
    """
    rows = df.select(*keys, F.posexplode_outer(column).alias(pos, value))
    return rows.filter(F.col(pos).isNotNull()).withColumn(pos, F.col(pos).cast("bigint"))
