"""Filters of bounded size over 64-bit keys: a key that was put in is always found,
another one rarely, and more often where there are more keys than the largest
filter is made for. They only spare work that a join repeats exactly."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = (16, 28)  # of a filter, as powers of two: about 12 a key, at least and at most
_PIECE = 12  # 64-bit words of a piece of a filter, as a power of two
_SPREAD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93))


def _power(bits):
    return (len(bits) * 64).bit_length() - 1


def _place(keys, spread, power):
    return ((keys ^ (keys >> np.uint64(31))) * spread) >> np.uint64(64 - power)


def _set(bits, keys):
    for spread in _SPREAD:
        place = _place(keys, spread, _power(bits))
        np.bitwise_or.at(bits, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))


def found(bits, keys):
    """Which of the keys (uint64) the filter holds; a filter of None holds none."""
    out = np.zeros(len(keys), bool)
    if bits is None:
        return out
    left = np.arange(len(keys))
    for spread in _SPREAD:
        place = _place(keys[left], spread, _power(bits))
        left = left[(bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)]
    out[left] = True
    return out


def filter_of(keys_of, df, count):
    """The filter of the keys that ``keys_of`` makes of each batch of ``df``, about
    ``count``, or None without keys. The driver sees its bits, 32 MB at most, as
    bytes of whole pieces, 1,024 rows at most."""
    power = min(max(BITS[0], (12 * count).bit_length()), BITS[1])
    piece = min(_PIECE, power - 6)

    def run(batches):
        bits = np.zeros(1 << power - 6, np.uint64)
        for batch in batches:
            _set(bits, keys_of(batch))
        at = np.flatnonzero(bits)
        yield pd.DataFrame({"piece": at >> piece, "at": at & (1 << piece) - 1, "bits": bits[at].view(np.int64)})

    def joined(rows):
        bits = np.zeros(1 << piece, np.int64)
        bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "data": [bits.tobytes()]})

    set_ = (df.mapInPandas(run, "piece long, at long, bits long").groupBy("piece", "at")
            .agg(F.bit_or("bits").alias("bits")))
    pieces = set_.groupBy("piece").applyInPandas(joined, "piece long, data binary").collect()
    if not pieces:
        return None
    bits = np.zeros(1 << power - 6, np.uint64)
    for row in pieces:
        bits[row["piece"] << piece:row["piece"] + 1 << piece] = np.frombuffer(row["data"], np.uint64)
    return bits


def may_hold(df, column):
    """A condition on whole numbers that the column of ``df`` may hold: true of
    all that it holds and of few others; false of null."""
    keys = df.select(F.col(column).cast("long").alias("key")).where("key is not null")
    bits = filter_of(lambda batch: batch["key"].to_numpy(dtype=np.int64).view(np.uint64), keys, keys.count())

    @F.pandas_udf(T.BooleanType())
    def holds(keys: pd.Series) -> pd.Series:
        return pd.Series(found(bits, keys.to_numpy(dtype=np.int64).view(np.uint64)))
    return lambda c: F.coalesce(c.isNotNull() & holds(F.coalesce(c.cast("long"), F.lit(0))), F.lit(False))
