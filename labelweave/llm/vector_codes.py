"""Vector code compression with exact integer arithmetic on float64 BLAS.

Components become integers, a vector is cut into four parts, and every part is
written as the number of its nearest codebook entry. Distances are exact: the
integers are split into limbs so narrow that a product of two limb matrices stays
below 2^53, where float64 matrix products are exact; the products are put together
in int64. The nearest entry is then the first minimum, the same on every machine.

A round assigns every part and replaces each entry by the floor of its parts'
mean. Tasks add up their parts by entry; their sums are added in two levels, so
that the driver sees a fixed number of sums, whatever the number of rows.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from labelweave.llm.common import table
from labelweave.session import materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
_GATHERED = 8  # rows of partial sums that reach the driver, at most
_SAFE_BITS = 62  # of a squared distance in int64
_ROWS = 4096  # parts whose distances are held at once


def limb_bits(width):
    """Bits of a limb so that a dot product of ``width`` limb products, of either
    sign, is below 2^53."""
    return (52 - max(0, (width - 1).bit_length())) // 2


def limbs(values, bits):
    """The integers as float64 limbs, lowest first: values = sum limb << bits*i.
    All limbs but the highest lie in [0, 2^bits); the highest bears the sign."""
    out, rest = [], values
    while True:
        if not rest.size or (rest.min() >= -(1 << bits) and rest.max() < 1 << bits):
            return out + [rest.astype(np.float64)]
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits


def exact_products(a, b):
    """a @ b.T of two int64 matrices, exact wherever it fits into int64."""
    bits = limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << np.int64(bits * (i + j))
    return out


def _fits(parts, entries):
    """Whether every squared distance stays within int64."""
    top = max((max(abs(int(x.min())), abs(int(x.max()))) for x in (parts, entries) if x.size), default=0)
    return parts.shape[1] * (2 * top) ** 2 < 1 << _SAFE_BITS


def nearest(parts, entries):
    """Index of the nearest entry of every part (the first of several) and its
    squared distance. Integers too large for int64 distances are reckoned in
    Python's, as objects."""
    if parts.dtype == object or entries.dtype == object or not _fits(parts, entries):
        parts, entries = parts.astype(object), entries.astype(object)
        at, far = [], []
        for part in parts:
            distances = [sum((x - y) * (x - y) for x, y in zip(part, entry)) for entry in entries]
            far.append(min(distances))
            at.append(distances.index(far[-1]))
        return np.array(at, np.int64), np.array(far, object)
    norms = (entries * entries).sum(1)
    at, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for first in range(0, len(parts), _ROWS):
        block = parts[first:first + _ROWS]
        scores = norms - 2 * exact_products(block, entries)
        best = scores.argmin(1)
        at[first:first + _ROWS] = best
        far[first:first + _ROWS] = scores[np.arange(len(block)), best] + (block * block).sum(1)
    return at, far


def cut(vectors):
    """The four consecutive parts of the rows of a matrix. Where four does not
    divide the length, the first parts are one component longer."""
    return np.array_split(vectors, PARTS, axis=1)


def _whole(rows):
    """Rows of decimal strings of integers as a matrix, of objects where some
    do not fit into int64."""
    try:
        return np.array([[int(x) for x in row] for row in rows], np.int64)
    except OverflowError:
        return np.array([[int(x) for x in row] for row in rows], object)


def _matrices(batch, width):
    """The batch's vectors of the codebooks' length, as one matrix of int64 and
    one of objects (of vectors with larger integers), each with its rows."""
    for column, large in (("small", False), ("large", True)):
        at = [i for i, v in enumerate(batch[column]) if v is not None and len(v) == width]
        if at:
            rows = [batch[column].iloc[i] for i in at]
            yield np.array(at), _whole(rows) if large else np.stack(rows).astype(np.int64)


def _add(sums, part, at, rows, entries):
    """Counts and sums of the rows by entry, added to sums[part]."""
    count, total = sums.setdefault(part, [np.zeros(entries, np.int64), np.zeros((entries, rows.shape[1]), object)])
    count += np.bincount(at, minlength=entries)
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    if len(found):
        total[found] += np.add.reduceat(rows[order], first, axis=0).astype(object)


def _pack(sums):
    return pd.DataFrame([(part, count.tolist(), [str(x) for x in total.ravel()])
                         for part, (count, total) in sums.items()], columns=["part", "counts", "totals"])


def _entry_sums(vectors, books, width):
    """counts and totals of every part and entry over all rows, as
    {part: (counts, totals)}."""
    entries = len(books[0])

    def local(batches):
        sums = {}
        for batch in batches:
            for _, matrix in _matrices(batch, width):
                for part, rows in enumerate(cut(matrix)):
                    _add(sums, part, nearest(rows, books[part])[0], rows, entries)
        yield _pack(sums)

    def gather(batches):
        sums = {}
        for batch in batches:
            for part, counts, totals in zip(batch["part"], batch["counts"], batch["totals"]):
                more = np.array([int(x) for x in totals], object).reshape(books[part].shape)
                have = sums.setdefault(part, [np.zeros(entries, np.int64), np.zeros(more.shape, object)])
                have[0] += np.asarray(counts, np.int64)
                have[1] = have[1] + more
        yield _pack(sums)

    columns = "part int, counts array<long>, totals array<string>"
    parts = vectors.select("small", "large").mapInPandas(local, columns)
    some = parts.repartition(_GATHERED).mapInPandas(gather, columns).toPandas()
    out = {}
    for batch in gather([some]):
        for part, counts, totals in zip(batch["part"], batch["counts"], batch["totals"]):
            out[part] = np.array(counts, np.int64), np.array([int(x) for x in totals], object).reshape(books[part].shape)
    return out


def integer_vectors(df):
    """vec_id, label, and the integers floor(SCALE * x) of every vector that
    takes part: ``small`` (longs) where all of them are below 2^31, else ``large``
    (decimal strings, since a float may exceed a long)."""
    x = lambda c: c.cast("double")
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf")))
    scaled = lambda c: F.floor(x(c) * SCALE)
    small = F.forall("embedding", lambda c: F.abs(x(c)) * SCALE < float(1 << 31))
    # A float so large is whole already; its decimal digits are exact in Python only.
    large = F.transform("embedding", lambda c: F.format_string("%s", x(c)))
    return (df.select("vec_id", "label", "embedding").where("embedding is not null").where(whole)
            .select("vec_id", "label", F.when(small, F.transform("embedding", scaled)).alias("small"),
                    F.when(~small, large).alias("large")))


def _exact_large(vectors):
    """``large`` as decimal integers: floor(SCALE * x) of the floats written."""
    def run(batches):
        for batch in batches:
            batch["large"] = [None if v is None else [str(_floor(float(x))) for x in v] for v in batch["large"]]
            yield batch

    return vectors.mapInPandas(run, vectors.schema)


def _floor(x):
    up, down = x.as_integer_ratio()
    return SCALE * up // down


def first_codebooks(vectors, entries=ENTRIES):
    """The parts of the vectors of the smallest ids, as matrices, and their
    length: that of the first of them. Vectors of other lengths are no entries."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("small").asc_nulls_last(), F.col("large").asc_nulls_last()]
    length = F.size(F.coalesce(F.col("small").cast("array<string>"), "large"))
    first = vectors.select("vec_id", "small", "large", length.alias("length")).orderBy(*order).limit(1).collect()
    if not first:
        return None, 0
    width = first[0]["length"]
    rows = (vectors.where(length == width).select("vec_id", "small", "large").orderBy(*order).limit(entries).collect())
    matrix = _whole([r["small"] if r["small"] is not None else r["large"] for r in rows])
    return cut(matrix), width


def _tight(matrix):
    """Objects as int64 where all of them fit."""
    try:
        return matrix.astype(np.int64)
    except OverflowError:
        return matrix


def codebooks(vectors, rounds=ROUNDS, entries=ENTRIES):
    """The final entries of each part, and the length of the vectors they are for."""
    books, width = first_codebooks(vectors, entries)
    for _ in range(rounds if books else 0):
        sums = _entry_sums(vectors, books, width)
        for part, (counts, totals) in sums.items():
            used = counts > 0
            fresh = books[part].astype(object)
            fresh[used] = totals[used] // counts[used].astype(object)[:, None]
            books[part] = _tight(fresh)
    return books, width


def books_digest(books):
    """SHA-256 of all components by part, entry and position."""
    text = ",".join(str(int(x)) for book in books or [] for entry in book for x in entry)
    return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors, books, width):
    """vec_id, label, code and error of every row."""
    def run(batches):
        for batch in batches:
            codes, errors = [None] * len(batch), [None] * len(batch)
            for at, matrix in _matrices(batch, width):
                code, error = [""] * len(at), np.zeros(len(at), object)
                for part, rows in enumerate(cut(matrix)):
                    best, far = nearest(rows, books[part])
                    code = [c + f"{b:02x}" for c, b in zip(code, best)]
                    error = error + far.astype(object)
                for i, c, e in zip(at, code, error):
                    codes[i], errors[i] = c, int(e) if e < 1 << 63 else None
            yield pd.DataFrame({"vec_id": batch["vec_id"].astype("Int64"), "label": batch["label"].astype("Int64"),
                                "code": codes, "error": pd.array(errors, "Int64")})

    wide = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "small", "large")
    return wide.mapInPandas(run, "vec_id long, label long, code string, error long")


def compress(df, rounds=ROUNDS, entries=ENTRIES):
    """vec_id, label, code, error, label_error and codebooks_sha256 of every
    vector that takes part.

    Vectors that are null or hold null or non-finite components do not. Repeated
    rows count as often as they occur; of equal vec_ids the lesser vector is the
    earlier entry, and a null vec_id comes last. A vector of another length than
    that of the smallest vec_id fits no codebook: its code and error are null, and
    it adds nothing to its label. An error beyond a long is null, and so is its
    label's sum then. Fewer vectors than entries make smaller codebooks; an empty
    table gives no rows.
    """
    vectors = integer_vectors(df)
    if vectors.where("large is not null").limit(1).count():
        vectors = _exact_large(vectors)
    vectors = materialise(vectors, "integers")
    books, width = codebooks(vectors, rounds, entries)
    if books is None:
        books = []
    coded = materialise(encode(vectors, books, width), "codes")
    total = F.when(F.count_if(F.col("error").isNull() & F.col("code").isNotNull()) == 0, F.try_sum("error"))
    labels = materialise(coded.groupBy(F.col("label").alias("__label")).agg(total.alias("label_error")), "labels")
    return (coded.join(labels, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
            .withColumn("codebooks_sha256", F.lit(books_digest(books))))


def op12_vector_codes(spark, sf_dir):
    return compress(table(spark, sf_dir, "embeddings")).drop("label")


def _oracle():
    """The rounds written out, one after the other."""
    parts = f"""
with recursive kept as materialized (
  select vec_id, label, row_number() over () as row_no,
         list_transform(embedding, lambda x: cast(floor(x::double * {SCALE}) as bigint)) as v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
item as materialized (
  select row_no, i // (len(v) // {PARTS}) as part, i % (len(v) // {PARTS}) as pos, v[i + 1] as x
  from (select row_no, v, unnest(range(len(v))) as i from kept)),
seed as (select row_no, row_number() over (order by vec_id, v) - 1 as entry from kept qualify entry < {ENTRIES}),
book0 as materialized (select part, entry, pos, x as c from item join seed using (row_no))"""
    for n in range(ROUNDS + 1):
        parts += f""",
far{n} as (
  select row_no, item.part, entry, cast(sum((x - c) * (x - c)) as bigint) as far
  from item join book{n} b on item.part = b.part and item.pos = b.pos group by all),
best{n} as materialized (
  select row_no, part, arg_min(entry, far * {ENTRIES} + entry) as entry, min(far) as far from far{n} group by all)"""
        if n < ROUNDS:
            parts += f""",
mean{n} as (
  select part, entry, pos, cast(floor(sum(x)::hugeint // count(*) - case when sum(x) % count(*) < 0 then 1 else 0 end)
         as bigint) as c
  from best{n} join item using (row_no, part) group by part, entry, pos),
book{n + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce(m.c, b.c) as c
  from book{n} b left join mean{n} m on b.part = m.part and b.entry = m.entry and b.pos = m.pos)"""
    return parts + f""",
code as (
  select row_no, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(far) as bigint) as error
  from best{ROUNDS} group by row_no)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(c as varchar), ',' order by part, entry, pos)) from book{ROUNDS})
         as codebooks_sha256
from kept join code using (row_no)
"""


ORACLE = _oracle()
