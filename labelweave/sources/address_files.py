"""Address CSV files: folder trees, mixed headers, lists of files."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import fields as fx
from labelweave.session import materialise
from labelweave.sources import csv_records as cr

_CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true",
        "encoding": "UTF-8", "recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}

POSITIONAL_SCHEMA = ", ".join(f"{label} string" for label in fixed.FILE_LABELS)


def with_path(df, name="path"):
    return df.withColumn(name, fx.file_path_text(F.col("_metadata.file_path")))


def read_tree(spark, root, sep=",", stream=False):
    """All ``.csv`` files below a folder as positional columns with their path.

    Header lines are skipped per file, blank lines are dropped, short lines
    are padded. One scan over all files; Spark splits large ones.
    """
    reader = spark.readStream if stream else spark.read
    return with_path(reader.schema(POSITIONAL_SCHEMA).options(sep=sep, **_CSV).csv(root))


def read_raw_lines(spark, root):
    """The same files as unparsed lines without the first line of each file,
    whatever it says. A separator and quote that no line holds leave lines whole."""
    return with_path(spark.read.schema("value string").options(
        header="true", sep="\u0001", quote="", enforceSchema="true", recursiveFileLookup="true",
        pathGlobFilter="*.csv").csv(root))


def with_parts(df, root, path="path", name="parts", readable=True):
    """Folder and file names below ``root``; blanks for underscores if readable."""
    below = fx.relative_path(F.col(path), root)
    return df.withColumn(name, fx.parts_of(fx.readable(below) if readable else below))


def read_tree_records(spark, root, sep=","):
    """The files of ``read_tree`` by the same columns, with records that go over
    several lines; large files are split all the same. The first record of a file
    is its header."""
    records = cr.csv_records(spark, root, sep).where(F.trim(F.col("record")) != "")
    heads = cr.headers_of(records, sep).select("file", "header_at")
    rows = records.join(heads, "file").where("start > 0 or at <> header_at")
    values = rows.select(fx.file_path_text(F.col("file")).alias("path"), cr.split_record(F.col("record"), sep).alias("_v"))
    return values.select(*[fx.empty_to_null(F.get("_v", F.lit(i))).alias(label)
                           for i, label in enumerate(fixed.FILE_LABELS)], "path")


def records_by_header(records, sep=","):
    """(rows, headers) of csv_records: the rows that are no header with ``values``,
    ``n_names`` of their header and ``places``, its map from label to the places of
    its columns, and the written headers with ``names`` and ``places``.

    The header is one row of its file joined to the others, so that files of any
    number of layouts are one plan.
    """
    records = records.where(F.trim(F.col("record")) != "")
    headers = materialise(cr.headers_of(records, sep).withColumn("places", cr.label_places(F.col("names"))), "headers")
    rows = (records.join(headers.select("file", "header_at", F.size("names").alias("n_names"), "places"), "file").where("start > 0 or at <> header_at")
            .withColumn("values", cr.split_record(F.col("record"), sep)))
    return rows, headers


def labelled_columns(rows, labels):
    """``values`` and ``places`` as one column per label, null where a file has none."""
    return rows.withColumns({label: cr.value_at(F.col("values"), F.col("places")[label]) for label in labels})


def read_by_header(spark, paths, sep=",", keep_path=True):
    """Files whose columns differ, mapped by name and put together by label.

    A header is the first record of a file that is not blank, parsed as such:
    names may be quoted and hold separators. Where several columns mean one label
    the first value counts that is not empty. Columns of unknown names are left
    out, and so are values beyond the header. Records may go over several lines.
    """
    rows, headers = records_by_header(cr.csv_records(spark, paths, sep), sep)
    held = {r["label"] for r in headers.select(F.explode(F.map_keys("places")).alias("label")).distinct().collect()}
    if not held and not headers.limit(1).count():
        raise ValueError(f"no .csv file with a header below {paths}")
    labels = [label for label in dict.fromkeys(fx.FOLDED_LABELS.values()) if label in held]
    named = labelled_columns(rows.withColumn("path", fx.file_path_text(F.col("file"))), labels)
    return named.select(*(["path"] if keep_path else []), *labels)


def read_csv(spark, paths, schema=None, sep=","):
    """CSV with header; types are inferred only where no schema is given."""
    reader = spark.read.options(sep=sep, header="true", encoding="UTF-8", quote='"', escape='"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(paths)


def read_manifest(spark, manifest, base, read):
    """The files a text file names, read together by ``read(list of paths)``.

    File names are the only rows that reach the driver.
    """
    names = spark.read.text(manifest).select(F.trim("value").alias("name"))
    listed = [row["name"] for row in names.filter("name <> ''").toLocalIterator()]
    return read([f"{base.rstrip('/')}/{name}" for name in listed])
