"""Mixing sources to target weights by a low-discrepancy schedule.

Slots are numbered; the golden-ratio point of a slot's number falls on one source
of the cumulative targets, so every stretch of the schedule holds the sources in
proportion. Slots are ranked within their source. The words of a source, its
documents shuffled, are walked round until its target is reached, and cut into as
many equal blocks as the source has slots; the n-th slot takes the n-th block. So
every source meets its target to a word, whatever its size beside the others.
DataFrame functions only.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labelweave.llm.common import table, whole_text, word_array, word_count
from labelweave.session import materialise

SLOT_WORDS = 256  # of the mix to a slot
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
GOLDEN = 0.6180339887498949
_GRID = 1024  # cells in which points and sources meet
_RUN = 1024  # slots ranked together
_BUCKET_HEX = 3  # leading digits of the shuffle key that are summed together


def source_targets(sized):
    """One row per source: number, size, target, and where its share begins.

    Sources in code point order, null last, share all words by weight. A target
    stops at three times the size of its source; what is left is shared by the
    others until none is above, that is, targets are the lesser of the limit and
    one level times the weight. Windows here run over one row per source.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    by_name, by_room = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("room", "source_no")
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("source_no") - 1) % len(WEIGHTS) + 1).cast("int"))
    spent = F.sum("most").over(by_room) - F.col("most")
    ahead = F.sum("weight").over(everything) - F.sum("weight").over(
        by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("weight")
    level = (F.col("total") - F.col("spent")) / F.col("ahead")
    return (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumns({"source_no": number, "total": total})
            .withColumn("weight", weight).withColumn("most", MAX_PASSES * F.col("source_size"))
            .withColumn("room", F.col("most") / F.col("weight"))
            .withColumns({"spent": spent.cast("double"), "ahead": ahead})
            .withColumn("level", F.first(F.when(level <= F.col("room"), level), ignorenulls=True).over(everything))
            .withColumn("target", F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")))
            .withColumn("begin", F.sum("target").over(by_name) - F.col("target"))
            .withColumn("end", F.lead("begin").over(by_name))
            .select("source", "source_no", "source_size", "target", "begin", "end"))


def schedule(sources, total, slot_words=SLOT_WORDS):
    """slot, source_no and rank of every slot of the mix.

    ``sources`` is a written table of source_targets. A source with a target on
    which no point falls gets one slot behind the others.
    """
    spark = sources.sparkSession
    slots = -(-total // slot_words)
    turn = F.col("slot") * F.lit(GOLDEN)
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("point", turn - F.floor(turn))
              .withColumn("cell", F.floor(F.col("point") * _GRID)).withColumn("place", F.col("point") * total))
    cell = lambda c: F.least(F.floor(c / total * _GRID), F.lit(_GRID - 1))
    shares = (sources.where("target > 0")
              .withColumn("cell", F.explode(F.sequence(cell(F.col("begin")), cell(F.coalesce("end", F.lit(total))))))
              .select("cell", "source_no", "begin", "end"))
    placed = (points.join(shares, "cell")
              .where("place >= begin and (end is null or place < end)").select("slot", "source_no"))
    placed = materialise(placed, "slots")
    none = (sources.where("target > 0").join(placed.select("source_no").distinct(), "source_no", "left_anti")
            .select((F.lit(slots) + F.col("source_no")).cast("long").alias("slot"), "source_no"))
    placed = placed.unionByName(none).withColumn("run", F.floor(F.col("slot") / _RUN))
    starts = placed.groupBy("source_no", "run").count()
    starts = starts.select("source_no", "run", (F.sum("count").over(
        Window.partitionBy("source_no").orderBy("run")) - F.col("count")).alias("start"))
    within = F.row_number().over(Window.partitionBy("source_no", "run").orderBy("slot")) - 1
    return (placed.withColumn("within", within).join(starts, ["source_no", "run"])
            .select("slot", "source_no", (F.col("start") + F.col("within")).alias("rank")))


def shuffled(sized, sources):
    """Where each document begins in the shuffled words of its source.

    Documents follow the md5 of their number. Sums run within the leading digits
    of that key, and a bucket begins where those before it end, so that a source
    of most documents is not summed in one task.
    """
    known = sources.select(F.col("source").alias("__source"), "source_no", "source_size", "target")
    keyed = (sized.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
             .withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
             .withColumn("bucket", F.substring("key", 1, _BUCKET_HEX)))
    starts = keyed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    starts = starts.select("source_no", "bucket", (F.sum("words").over(
        Window.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("bucket_begin"))
    order = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "size", "digest")
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    return (keyed.withColumns({"nth": F.row_number().over(order), "before": before})
            .join(starts, ["source_no", "bucket"])
            .withColumn("begin", F.col("bucket_begin") + F.col("before"))
            .drop("before", "bucket_begin", "key"))


def _block_begin(rank):
    """Where the block of a rank begins in the walk of its source: the first
    ``longer`` of its slots take one word more than ``words``."""
    return rank * F.col("words") + F.least(rank, F.col("longer"))


def _block_of(place):
    """The rank of the block that a place of the walk is in."""
    ahead = F.col("longer") * (F.col("words") + 1)
    return F.when(place < ahead, F.floor(place / (F.col("words") + 1))).otherwise(
        F.col("longer") + F.floor(F.try_divide(place - ahead, F.col("words"))))


def pieces(placed, slots):
    """A row per document, pass and slot that takes words of it: ``pass``, ``slot``,
    ``from`` (the words of the document before the piece) and ``taken``. Documents
    of which nothing is taken keep one row, with nulls. ``placed`` are the shuffled
    documents, ``slots`` a written schedule.
    """
    counts = slots.groupBy("source_no").agg(F.count("*").alias("slots"))
    goal = F.least(F.round("target").cast("long"), MAX_PASSES * F.col("source_size"))
    walks = (placed.join(counts, "source_no", "left").withColumn("goal", goal)
             .withColumns({"words": F.floor(F.col("goal") / F.col("slots")), "longer": F.col("goal") % F.col("slots")}))
    starts = F.transform(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1)), lambda k: F.struct(
        k.alias("pass"), (F.col("begin") + k * F.col("source_size")).alias("first"),
        F.least(F.col("begin") + k * F.col("source_size") + F.col("size"), F.col("goal")).alias("last")))
    some = F.when(F.col("slots").isNotNull(), F.filter(starts, lambda x: x.first < x.last))
    walks = walks.withColumn("walk", F.explode_outer(some)).select("*", "walk.*").drop("walk")
    ranks = F.sequence(_block_of(F.col("first")), _block_of(F.col("last") - 1))
    reach = walks.withColumn("rank", F.explode_outer(F.when(F.col("first").isNotNull(), ranks)))
    at = F.greatest(F.col("first"), _block_begin(F.col("rank")))
    end = F.least(F.col("last"), _block_begin(F.col("rank") + 1))
    return (reach.join(slots, ["source_no", "rank"], "left")
            .withColumns({"from": at - F.col("first"), "taken": end - at})
            .drop("words", "longer", "slots", "goal", "rank", "first", "last"))


def mix(df):
    """One row per document and pass that takes some of it: doc_id, source, digest
    (md5 of the text), nth (among rows equal in these), size, source_size, target,
    pass, slot (the first that takes of it), taken (words). A document of which
    nothing is taken has one row, with null pass and slot and taken 0.

    A null text has no words; it is taken nowhere. A null source is a source.
    Repeated rows are documents of their own. An empty table gives no rows.
    """
    sized = materialise(df.select("doc_id", "source", F.md5(whole_text()).alias("digest"),
                                  word_count(whole_text()).alias("size")), "sizes")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    sources = materialise(source_targets(sized), "sources")
    slots = materialise(schedule(sources, total), "schedule")
    key = ["doc_id", "source", "digest"]
    placed = shuffled(sized, sources).withColumn("nth", F.row_number().over(
        Window.partitionBy("source_no", "bucket", "doc_id", "digest").orderBy("begin")))
    return (pieces(placed, slots).groupBy(*key, "nth", "size", "source_size", "target", "pass")
            .agg(F.min("slot").alias("slot"), F.coalesce(F.sum("taken"), F.lit(0)).alias("taken")))


def mixed_documents(df):
    """The rows of ``df`` as often as the mix takes them, with all columns, in the
    order of the schedule.

    A document is one row for every pass that takes it. The one document of a
    source at which its last pass ends is, in that pass, the words taken of it,
    from its beginning. Documents that are not taken go.
    """
    whole = lambda *c: F.md5(F.to_json(F.struct(*c), {"ignoreNullFields": "false"}))
    taken = mix(df).where("taken > 0").select(
        whole("doc_id", "source", "digest").alias("__key"), F.col("nth").alias("__nth"),
        F.col("size").alias("__size"), F.col("taken").alias("__taken"), F.col("slot").alias("__slot"))
    # One key for the numbering and the join, so that the texts are moved once.
    rows = df.withColumn("__key", whole("doc_id", "source", F.md5(whole_text()).alias("digest")))
    rows = rows.withColumn("__nth", F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(0))))
    cut = F.col("__taken") < F.col("__size")
    part = F.array_join(F.slice(word_array(whole_text()), F.lit(1), F.col("__taken").cast("int")), " ")
    joined = rows.join(taken, ["__key", "__nth"]).withColumn("text", F.when(cut, part).otherwise(F.col("text")))
    if "n_chars" in df.columns:
        joined = joined.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")))
    ordered = joined.repartitionByRange("__slot", "__key").sortWithinPartitions("__slot", "__key", "__nth")
    return ordered.select(*df.columns)


def op7_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mix(docs).groupBy("doc_id", "source", "digest", "nth", "size", "source_size", "target")
            .agg(F.sum("taken").cast("long").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


ORACLE = r"""
with sized as (
  select doc_id, source, md5(coalesce(text, '')) as digest,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
n as (select sum(size) as total from sized),
a as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) as source_no from sized group by source),
b as (
  select *, (source_no - 1) % 3 + 1 as weight, 3 * source_size as most,
         3 * source_size / ((source_no - 1) % 3 + 1) as room from a),
c as (
  select *, sum(most) over r - most as spent, sum(weight) over () - sum(weight) over r + weight as ahead
  from b window r as (order by room, source_no rows unbounded preceding)),
lev as (
  select first((total - spent) / ahead order by room, source_no) as level
  from c, n where (total - spent) / ahead <= room),
t as (
  select source, source_no, source_size, least(cast(most as double), level * weight) as target from c, lev),
placed as (
  select doc_id, size, t.source_size, target, least(cast(round(target) as bigint), 3 * t.source_size) as goal,
         sum(size) over (partition by source_no order by md5(cast(doc_id as varchar)), doc_id, size, digest
                         rows unbounded preceding) - size as lo
  from sized join t on sized.source is not distinct from t.source)
select doc_id, size, source_size, target, cast(list_sum(list_transform(range(3), lambda k:
         greatest(0, least(lo + k * source_size + size, goal) - (lo + k * source_size)))) as bigint) as taken
from placed
"""
