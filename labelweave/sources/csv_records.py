"""CSV records that may go over several lines, from files that Spark splits.

A line begins inside a quoted value or it does not, which only the lines before
it tell. What a line does to that state is known from the line alone, so the
state is carried along by composition: within a split over its lines, over the
splits of a file by what each does as a whole. Lines of splits without open
quotes are records as they are and are not moved.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.functions import fields as fx
from labelweave.session import materialise

_SPLIT = ["file", "start"]


def _patterns(sep):
    """What regular expressions match a line that leaves a quote open: one that
    begins a record, and one that begins inside a quoted value. A quote opens a
    value at its beginning only."""
    s = "\\t" if sep == "\t" else "\\" + sep
    text = '(?:[^"]++|"")*+'
    field = f'[ ]*+(?:"{text}"[^{s}]*+|(?!")[^{s}]*+)'
    opening = f'(?:{field}{s})*+[ ]*+"{text}\\z'
    return f"^{opening}", f'^{text}(?:\\z|"[^{s}]*+{s}{opening})'


def split_record(record, sep=","):
    """The values of a record: blanks before a value and the quotes around it are
    left out, a doubled quote is one."""
    s = "\\t" if sep == "\t" else "\\" + sep
    found = F.regexp_extract_all(F.concat(F.lit(sep), record),
                                 F.lit(f'{s}[ ]*+("(?:[^"]++|"")*+"?[^{s}]*+|[^{s}]*+)'), 1)
    part = lambda v, n: F.regexp_extract(v, '(?s)^"((?:[^"]++|"")*+)"?(.*+)\\z', n)
    return F.transform(found, lambda v: F.when(
        F.startswith(v, F.lit('"')), F.concat(F.replace(part(v, 1), F.lit('""'), F.lit('"')), part(v, 2))).otherwise(v))


def _after(frame, opens, stays, order, entered):
    """Adds ``after``: whether a quote is open after a row, when ``entered`` says
    whether one is before the first of its group. A row that opens and stays
    leaves it open whatever was before, one that does neither leaves it closed,
    one that opens and does not stay turns it over."""
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = frame.withColumn("_turns", F.sum(F.when(opens & ~stays, 1).otherwise(0)).over(so_far))
    fixed = F.when(opens == stays, F.struct(opens.alias("to"), F.col("_turns").alias("turns")))
    held = turned.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(so_far))
    odd = (F.col("_turns") - F.coalesce("_fixed.turns", F.lit(0))) % 2 == 1
    return held.withColumn("after", F.coalesce("_fixed.to", entered) != odd).drop("_turns", "_fixed")


def marked_lines(spark, paths, sep=",", files="*.csv"):
    """Every line with its file, the start of its split, its place there, and
    ``opens`` and ``stays``: whether a quote is open behind it, when it begins a
    record, and when it begins inside a value."""
    begins, inside = _patterns(sep)
    lines = spark.read.options(lineSep="\n", recursiveFileLookup="true", pathGlobFilter=files).text(paths)
    value = F.regexp_replace("value", "\\r\\z", "")
    quoted = F.contains(F.col("value"), F.lit('"'))
    return (lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                         F.monotonically_increasing_id().alias("at"), value.alias("value"))
            .withColumns({"opens": quoted & F.regexp_like("value", F.lit(begins)),
                          "stays": ~quoted | F.regexp_like("value", F.lit(inside))}))


def split_states(lines):
    """A written table of the splits of ``lines``: whether one is entered inside
    a value (``entered``), is left inside one (``after``), and whether a line of it
    opens one (``opening``)."""
    splits = materialise(lines.groupBy(*_SPLIT).agg(
        F.bool_or("opens").alias("opening"), F.bool_and("stays").alias("stays")), "splits")
    opening = splits.where("opening").select(*_SPLIT)
    order = Window.partitionBy(*_SPLIT).orderBy("at")
    inner = lines.select(*_SPLIT, "at", "opens", "stays").join(opening, _SPLIT)
    ends = _after(inner, F.col("opens"), F.col("stays"), order, F.lit(False)).withColumnRenamed("after", "shut")
    ends = _after(ends, F.col("opens"), F.col("stays"), order, F.lit(True))
    ends = ends.groupBy(*_SPLIT).agg(F.max_by("shut", "at").alias("end_opens"), F.max_by("after", "at").alias("end_stays"))
    whole = splits.join(ends, _SPLIT, "left").select(
        *_SPLIT, "opening", F.coalesce("end_opens", F.lit(False)).alias("opens"),
        F.coalesce("end_stays", "stays").alias("stays"))
    # One row per split from here on.
    by_file = Window.partitionBy("file").orderBy("start")
    state = _after(whole, F.col("opens"), F.col("stays"), by_file, F.lit(False))
    state = state.withColumn("entered", F.lag("after", 1, False).over(by_file))
    return materialise(state.select(*_SPLIT, "opening", "entered", "after"), "splits")


def csv_records(spark, paths, sep=",", files="*.csv"):
    """file, start, at, record and ``whole`` of every record, by ``start`` and ``at``
    in the order of its file. Line ends inside a quoted value stay, as ``\\n``. A
    record whose quote is open where the file ends is not whole.

    Only splits in which a quote stays open at the end of a line, or is open where
    they begin, are numbered line by line; a record is put together from its lines
    even if they lie in several splits.
    """
    lines = marked_lines(spark, paths, sep, files)
    plain = lines.select(*_SPLIT, "at", F.col("value").alias("record"), F.lit(True).alias("whole"))
    if not lines.where("opens").limit(1).count():
        return plain
    states = split_states(lines)
    moved = states.where("opening or entered")
    order = Window.partitionBy(*_SPLIT).orderBy("at")
    numbered = _after(lines.join(moved, _SPLIT).drop("after"), F.col("opens"), F.col("stays"), order, F.col("entered"))
    begins = ~F.coalesce(F.lag("after").over(order), F.col("entered"))
    numbered = numbered.withColumn("_begins", begins)
    numbered = materialise(numbered.withColumn("_no", F.sum(F.when(F.col("_begins"), 1).otherwise(0)).over(order))
                           .select(*_SPLIT, "at", "value", "after", "_no"), "lines")
    # Lines before the first record of a split belong to the last one before it.
    last = numbered.groupBy(*_SPLIT).agg(F.max("_no").alias("last"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("last") > 0, F.struct("start", F.col("last").alias("no"))), ignorenulls=True).over(before)
    owners = materialise(last.select(*_SPLIT, owner.alias("owner")), "owners")
    of = F.when(F.col("_no") > 0, F.struct("start", F.col("_no").alias("no"))).otherwise(F.col("owner"))
    joined = (numbered.join(owners, _SPLIT).groupBy("file", of.alias("of"))
              .agg(F.array_sort(F.collect_list(F.struct("start", "at", "value", "after"))).alias("parts")))
    several = joined.select(
        "file", F.get("parts", F.lit(0)).start.alias("start"), F.get("parts", F.lit(0)).at.alias("at"),
        F.array_join(F.transform("parts", lambda x: x.value), "\n").alias("record"),
        (~F.element_at("parts", -1).after).alias("whole"))
    return plain.join(moved.select(*_SPLIT), _SPLIT, "left_anti").unionByName(several)


def headers_of(records, sep=","):
    """file, at (of the header) and ``names``, the values of the first record that
    is not blank, without a byte order mark."""
    first = (records.where("start = 0").where(F.trim(F.col("record")) != "")
             .groupBy("file").agg(F.min_by("record", "at").alias("header"), F.min("at").alias("header_at")))
    return first.select("file", "header_at", F.transform(
        split_record(F.regexp_replace("header", "^\\ufeff", ""), sep), lambda v: F.trim(v)).alias("names"))


def label_places(names):
    """For the array of a file's column names a map from label to the places that
    mean it; unknown names are left out."""
    known = F.create_map(*[F.lit(x) for pair in fx.FOLDED_LABELS.items() for x in pair])
    folded = F.transform(names, lambda n, i: F.struct(
        F.try_element_at(known, F.upper(F.regexp_replace(n, "[ _]", ""))).alias("label"), i.alias("place")))
    told = F.filter(folded, lambda x: F.coalesce(x.label, F.lit("")) != "")
    labels = F.array_distinct(F.transform(told, lambda x: x.label))
    return F.map_from_arrays(labels, F.transform(labels, lambda label: F.transform(
        F.filter(told, lambda x: x.label == label), lambda x: x.place)))


def value_at(values, places):
    """The first value at the places that is not empty, or null."""
    at = lambda i: F.nullif(F.get(values, i), F.lit(""))
    several = F.get(F.filter(F.transform(places, at), lambda v: v.isNotNull()), F.lit(0))
    return F.when(F.size(places) == 1, at(F.get(places, F.lit(0)))).otherwise(several)
