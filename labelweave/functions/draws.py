"""Random draws that are a pure function of (key, purpose, step, seed).

A retried or moved task therefore repeats its draws exactly, and no result
depends on how the rows are partitioned. Keys and steps are given as SQL text,
so that draws can stand inside the lambdas of the higher-order functions.
"""

from pyspark.sql import functions as F

_RANGE = "4294967296.0D"  # 2^32, the range of eight hexadecimal digits


def uniform_text(key, purpose, step="0", seed=0):
    text = f"concat_ws('|', cast({key} as string), '{purpose}#{seed}', cast({step} as string))"
    return f"(cast(conv(substring(md5({text}), 1, 8), 16, 10) as double) / {_RANGE})"


def pick_text(key, purpose, size, step="0", seed=0):
    return f"cast(floor({uniform_text(key, purpose, step, seed)} * ({size})) as int)"


def hits_text(key, purpose, probability, limit, seed=0):
    branches = " ".join(
        f"when {uniform_text(key, purpose, step, seed)} >= {probability}D then {step - 1}"
        for step in range(1, limit + 1))
    return f"(case {branches} else {limit} end)"


def uniform(key, purpose, step="0", seed=0):
    """A double in [0, 1)."""
    return F.expr(uniform_text(key, purpose, step, seed))


def pick(key, purpose, size, step="0", seed=0):
    """An integer in [0, size)."""
    return F.expr(pick_text(key, purpose, size, step, seed))


def hits_in_a_row(key, purpose, probability, limit, seed=0):
    """How many draws in a row fall below ``probability``, at most ``limit``.

    The branches are tried in order, so a row pays for the draws up to its
    first miss only: 1.25 on average at 0.2.
    """
    return F.expr(hits_text(key, purpose, probability, limit, seed))
