"""Packing documents into fixed-length sequences.

How well pieces pack depends on their lengths alone, and there are at most as
many lengths as a sequence has tokens. So the whole corpus is packed on its
histogram of lengths: Martello and Toth's dominance reduction first fixes every
small set of pieces that provably does at least as well as any alternative for
its largest member, which shrinks the instance; best-fit packs the rest. The
plan is a short list of (pattern, how many sequences). Pieces are then ranked
within their length and take the places of the plan by rank, in parallel.
"""

import bisect
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm import byte_bpe
from labelweave.llm.common import table, whole_text
from labelweave.session import materialise

SEQUENCE_TOKENS = 1024
END_OF_TEXT = 2
RANK_ROWS = 20_000  # rows of one length ranked together
RANK_BUCKETS = 64


def document_pieces(df, capacity=SEQUENCE_TOKENS, end_id=END_OF_TEXT, path=None, with_ids=False):
    """One row per piece of a document: piece, start, length, ids_crc32.

    A document is the ids of its text and then the end id; a null text is an
    empty one, a single end id. Longer documents are cut from the back, so that
    only the first piece may be short. Repeated rows are documents of their own.
    ``with_ids`` adds the ids as little-endian unsigned 32-bit bytes.
    """
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    fields += ", ids binary" if with_ids else ""

    def cut(batches):
        bpe = byte_bpe.load(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(bpe.text_ids(text), end_id).astype("<u4")
                start, piece = 0, 0
                while start < len(ids):
                    size = (len(ids) - start) % capacity or capacity
                    data = ids[start:start + size].tobytes()
                    rows.append((doc_id, piece, start, size, zlib.crc32(data), data))
                    start, piece = start + size, piece + 1
            width = 6 if with_ids else 5
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:width]
            out = pd.DataFrame([r[:width] for r in rows], columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return df.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInPandas(cut, fields)


def reduce_by_dominance(count, capacity):
    """Fixes dominating sets; takes them out of ``count`` (length to number).

    For a piece j, with k the longest piece that fits beside it, these sets
    dominate every other feasible set with j, since each member of the other
    can be exchanged for members of the set that are at least as long:
    j alone, if nothing fits beside it; {j, k}, if it is full, if no two others
    fit, or if no three fit and no two together are longer than k; {j, k, b}, b
    the longest beside both, if no four fit and any two others fit member by
    member into k and b, or together into k. Only pieces shrink away, so a set
    that dominates does so as often as its lengths last.
    """
    fixed, moved = [], True
    while moved:
        moved = False
        for j in sorted(count, reverse=True):
            while count.get(j):
                chosen = _dominating(count, j, capacity)
                if not chosen:
                    break
                need = {w: chosen.count(w) for w in chosen}
                times = min(count[w] // n for w, n in need.items())
                fixed.append((times, sorted(need.items(), reverse=True)))
                for w, n in need.items():
                    count[w] -= times * n
                    if not count[w]:
                        del count[w]
                moved = True
    return fixed


def _dominating(count, j, capacity):
    left = dict(count)
    _take(left, j)
    room = capacity - j
    lengths = sorted(left)
    k = _longest(lengths, room)
    if not k:
        return [j]
    if k == room:
        return [j, k]
    smallest = []
    for w in lengths:
        smallest += [w] * min(left[w], 4 - len(smallest))
        if len(smallest) == 4:
            break
    fits = lambda n: len(smallest) >= n and sum(smallest[:n]) <= room
    if not fits(2):
        return [j, k]
    if fits(3):
        return None
    after = dict(left)
    _take(after, k)
    b = _longest(sorted(after), room - k)
    pairs_in_k = pairs_in_both = True
    for x in lengths:
        if x > k:
            break
        y = _longest(lengths, min(x, room - x))
        if y == x and left[x] < 2:
            y = _longest(lengths[:lengths.index(x)], min(x, room - x))
        if y:
            pairs_in_k &= x + y <= k
            pairs_in_both &= x + y <= k or bool(b) and y <= b
    if pairs_in_k:
        return [j, k]
    return [j, k, b] if b and pairs_in_both else None


def _take(left, w):
    left[w] -= 1
    if not left[w]:
        del left[w]


def _longest(lengths, most):
    at = bisect.bisect_right(lengths, most)
    return lengths[at - 1] if at else 0


def best_fit(count, capacity):
    """Best-fit decreasing on the histogram: equal bins are handled as one."""
    bins = {}  # free room -> {pattern: how many}
    for w in sorted(count, reverse=True):
        n = count[w]
        for room in sorted(r for r in bins if r >= w):
            for pattern, many in list(bins[room].items()):
                if not n:
                    break
                each = room // w
                for number, of in ((min(many, n // each), each), (1, 0)):
                    of = of or min(each, n)
                    if not number or not n or number > bins.get(room, {}).get(pattern, 0):
                        continue
                    bins[room][pattern] -= number
                    if not bins[room][pattern]:
                        del bins[room][pattern]
                    spot = bins.setdefault(room - of * w, {})
                    grown = pattern + ((w, of),)
                    spot[grown] = spot.get(grown, 0) + number
                    n -= number * of
        each = capacity // w
        for number, of in ((n // each, each), (1 if n % each else 0, n % each)):
            if number:
                spot = bins.setdefault(capacity - of * w, {})
                spot[((w, of),)] = spot.get(((w, of),), 0) + number
    return [(many, list(pattern)) for group in bins.values() for pattern, many in group.items()]


def plan_sequences(count, capacity=SEQUENCE_TOKENS):
    """List of (number of sequences, [(length, pieces of it), ...])."""
    left = {w: n for w, n in count.items() if n}
    if any(w < 1 or w > capacity for w in left):
        raise ValueError("a piece is empty or longer than a sequence")
    fixed = reduce_by_dominance(left, capacity)
    return fixed + best_fit(left, capacity)


def _places(plan):
    """Per length: first rank, first sequence, pieces per sequence and offset of
    every run of places, in rank order."""
    runs, taken, sequence = {}, {}, 0
    for number, pattern in plan:
        offset = 0
        for w, each in pattern:
            start = taken.get(w, 0)
            runs.setdefault(w, []).append((start, sequence, each, offset))
            taken[w], offset = start + number * each, offset + each * w
        sequence += number
    return {w: np.array(r, np.int64).T for w, r in runs.items()}


def with_rank(df, key, order):
    """``rank`` of each row within its key, from 0.

    Rows of a key are dealt to buckets; ranks count within a bucket, and a
    bucket starts where the buckets before it end, so no key is sorted in one
    task. ``df`` must be a written table, for it is read twice. Rows that tie in
    ``order`` get ranks in any order.
    """
    buckets = max(RANK_BUCKETS, df.count() // RANK_ROWS)
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    starts = dealt.groupBy(key, "__bucket").count().select(
        key, "__bucket", (F.sum("count").over(Window.partitionBy(key).orderBy("__bucket"))
                          - F.col("count")).alias("__start"))
    within = Window.partitionBy(key, "__bucket").orderBy(*order)
    return (dealt.withColumn("__within", F.row_number().over(within) - 1)
            .join(starts, [key, "__bucket"])
            .withColumn("rank", F.col("__start") + F.col("__within"))
            .drop("__bucket", "__start", "__within"))


def pack(pieces, capacity=SEQUENCE_TOKENS):
    """Adds sequence_id and offset to a written table of pieces.

    The driver sees the histogram of lengths, at most ``capacity`` numbers. No
    pieces give no rows.
    """
    count = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = _places(plan_sequences(count, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for w in np.unique(lengths):
            rows = np.flatnonzero(lengths == w)
            starts, first, each, begin = places[int(w)]
            run = np.searchsorted(starts, ranks[rows], "right") - 1
            nth = ranks[rows] - starts[run]
            sequence[rows] = first[run] + nth // each[run]
            offset[rows] = begin[run] + nth % each[run] * w
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    order = [c for c in pieces.columns if c != "ids"]
    ranked = with_rank(pieces, "length", order)
    return (ranked.withColumn("__place", place("length", "rank"))
            .select(*pieces.columns, "__place.sequence_id", "__place.offset"))


def sequences(packed):
    """The packed sequences themselves, from pieces that carry their ids."""
    return packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> a || p.ids)").alias("ids"))


def pack_documents(docs, capacity=SEQUENCE_TOKENS):
    return pack(materialise(document_pieces(docs, capacity), "pieces"), capacity)


def op4_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
