"""Files that arrive over time, labelled and appended to a train and a test corpus."""

from fnmatch import fnmatch
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.config import PRESETS
from labelweave.functions import fields as fx
from labelweave.operators import labelling as lab
from labelweave.operators.sampling import with_split
from labelweave.sources import address_files as af
from labelweave.sources import csv_records as cr
from labelweave.sources import described
from labelweave.sources.sinks import conll_blocks

_FILES = "path string, modificationTime timestamp, length long, content binary"  # of Spark's reader
_DROPPED = ("lon", "lat", "state_district", "id", "hash")
_FAILURES = (PySparkException, Py4JJavaError)
_KEPT = [label for label in fixed.FILE_LABELS if label not in _DROPPED]


def _keyed_pairs(df, pairs):
    """A row's key is its own content: the same after a restart or a retry."""
    content = F.concat_ws("|", F.col("path"), F.to_json(pairs))
    return df.select(F.md5(content).alias("key"), pairs.alias("pairs"))


def csv_rows(spark, paths, sep=","):
    """(rows, headers) of CSV files, by the names in their own headers. ``problem``
    says why a row cannot be used and is null where it can."""
    rows, headers = af.records_by_header(cr.csv_records(spark, paths, sep), sep)
    known = F.arrays_overlap(F.map_keys("places"), F.array(*map(F.lit, _KEPT)))
    beyond = F.exists(F.slice("values", F.col("n_names") + 1, F.size("values")), lambda v: v != "")
    problem = (F.when(~F.col("whole"), "a quote is open where the file ends")
               .when(~known, "no column of a known name").when(beyond, "more values than names"))
    return rows.withColumn("problem", problem), headers


def csv_pairs(rows):
    pairs = fx.label_value_list([(label, cr.value_at(F.col("values"), F.col("places")[label])) for label in _KEPT])
    usable = rows.where("problem is null").select(fx.file_path_text(F.col("file")).alias("path"), pairs.alias("pairs"))
    return _keyed_pairs(usable, F.col("pairs"))


def json_pairs(spark, paths):
    """Geocoder lines; see ``described.unreadable_geocoder_lines`` for the others."""
    rows = described.read_geocoder_lines(spark, paths, files="*")
    return _keyed_pairs(rows, F.col("pairs"))


def _problems(rows, text):
    """One row per file and problem: path, reason, how many lines, and one of them."""
    return rows.groupBy("path", "reason").agg(F.count("*").alias("lines"), F.min(text).alias("example"))


def uploads_of(spark, paths, json_files=described.GEOCODER_FILES):
    """(pairs, problems) of files told apart by name: ``.csv``, geocoder files, and
    all others, which are left alone. Both are None if no file is of use.

    ``problems`` has path, reason, lines and an example for all that gives no row:
    files without a header, without a column of a known name, rows with values
    beyond the header or an open quote, and lines that are no geocoder result.
    """
    name = lambda path: fx.plain_location(path).rsplit("/", 1)[-1]
    tables = [path for path in paths if name(path).endswith(".csv")]
    lines = [path for path in paths if path not in set(tables) and fnmatch(name(path), json_files)]
    plain = lambda some: sorted(fx.plain_location(path) for path in some)
    found, problems = [], []
    if tables:
        rows, headers = csv_rows(spark, plain(tables))
        found.append(csv_pairs(rows))
        text = fx.file_path_text(F.col("file")).alias("path")
        problems.append(_problems(rows.where("problem is not null").select(text, F.col("problem").alias("reason"), "record"),
                                  "record"))
        # Readers write the slashes behind a scheme in different numbers.
        place = lambda path: F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/").alias("place")
        listed = spark.createDataFrame([(path,) for path in plain(tables)], "path string")
        headless = listed.select("path", place(F.col("path"))).join(
            headers.select(place(fx.file_path_text(F.col("file")))), "place", "left_anti")
        problems.append(headless.select("path", F.lit("no header").alias("reason"),
                                        F.lit(0).cast("long").alias("lines"), F.lit("").alias("example")))
    if lines:
        found.append(json_pairs(spark, plain(lines)))
        bad = described.unreadable_geocoder_lines(spark, plain(lines), files="*").where(F.trim(F.col("value")) != "")
        problems.append(_problems(bad.select(fx.file_path_text(F.col("path")).alias("path"),
                                             F.lit("no geocoder result").alias("reason"), "value"), "value"))
    together = lambda some: reduce(lambda a, b: a.unionByName(b), some) if some else None
    return together(found), together(problems)


def uploads(spark, root, json_files=described.GEOCODER_FILES):
    """All uploads of a folder at once."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return uploads_of(spark, [row["path"] for row in listed.toLocalIterator()], json_files)[0]


def unreadable(spark, path):
    """Why Spark cannot read a file, or None if it can."""
    try:
        spark.read.text(fx.plain_location(path)).agg(F.max(F.length("value"))).collect()
    except _FAILURES as failure:
        return str(failure).strip().split("\n", 1)[0][:300]
    return None


def label_uploads(pairs, augmentation=PRESETS["full"], tag_mode="by_token"):
    """Order, tag and split; row by row, so batch and stream agree."""
    ordered = lab.with_order(pairs, "key", augmentation)
    return with_split(lab.label_pairs(ordered, tag_mode=tag_mode), "key")


def run_ingest(spark, root, out, checkpoint, sink="conll",
               json_files=described.GEOCODER_FILES, max_files=1000, quarantine=None, **settings):
    """Takes in what has arrived since the last run, and stops.

    The stream is of file names, at most ``max_files`` a batch; a file's content is
    read once its header is known, so that columns go by name. Every batch writes a
    folder of its own, ``batch=<number>/split=<name>``, and a repeated batch replaces
    it: each file is taken exactly once. The checkpoint lies in the shared folder of
    the caller.

    A bad upload keeps nothing from the others. What gives no row is written to
    ``quarantine`` (a folder beside ``out`` unless named), as JSON of path, reason,
    lines and an example, by batch. If a batch fails, its files are tried one by one;
    those that cannot be read are named there, the rest is written. Files of no bytes
    are not seen by Spark and give nothing.
    """
    quarantine = (quarantine or f"{out.rstrip('/')}_quarantine").rstrip("/")
    names = (spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files).load(root).select("path"))

    def write(session, paths, broken, number):
        pairs, problems = uploads_of(session, paths, json_files)
        if broken:
            named = session.createDataFrame([(fx.plain_location(p), why, 0, "") for p, why in broken],
                                            "path string, reason string, lines long, example string")
            problems = named if problems is None else problems.unionByName(named)
        if problems is not None:
            problems.write.mode("overwrite").json(f"{quarantine}/batch={number}")
        if pairs is None:
            return
        labelled = label_uploads(pairs, **settings)
        if sink == "conll":
            blocks = conll_blocks(labelled, keep=("split",))
            head = F.lit(f"{fixed.DOCSTART}\n\n")
            writer = blocks.select("split", F.concat(head, "block").alias("value")).write.format("text")
        else:
            writer = lab.annotate(labelled).select("key", "text", "label", "split").write.format("parquet")
        writer.mode("overwrite").partitionBy("split").save(f"{out.rstrip('/')}/batch={number}")

    def take(batch, number):
        session = batch.sparkSession
        paths = [row["path"] for row in batch.collect()]
        try:
            write(session, paths, [], number)
        except _FAILURES:
            broken = [(path, why) for path in paths for why in [unreadable(session, path)] if why]
            if not broken:
                raise
            bad = {path for path, _ in broken}
            write(session, [path for path in paths if path not in bad], broken, number)

    query = (names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
