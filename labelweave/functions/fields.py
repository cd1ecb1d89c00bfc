"""Fields of a record: cleaning, parsing and what a file path tells."""

import re
from urllib.parse import unquote

from pyspark.sql import functions as F

from labelweave import fixed


def empty_to_null(value):
    return F.nullif(value, F.lit(""))


def strip_periods(value):
    return F.replace(value, F.lit("."), F.lit(""))


def parse_line(line, names=fixed.FILE_LABELS):
    """One quoted CSV line to a struct; short lines are padded with NULL."""
    schema = ", ".join(f"`{name}` string" for name in names)
    options = {"sep": ",", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true"}
    return F.from_csv(line, schema, options)


# --- paths ------------------------------------------------------------------

def _without_scheme(path):
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path)


def path_depth(root):
    """Number of path segments in front of the first folder below ``root``."""
    return len([part for part in _without_scheme(root).split("/") if part])


def relative_path(path, root=None):
    """Folder and file names below ``root``, undecorated, with slashes between.

    Folders may be named ``value`` or, as a partitioned write names them,
    ``key=value``.
    """
    depth = path_depth(root) if root is not None else 0
    below = F.regexp_replace(path, f"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*(?:[^/]+/+){{{depth}}}", "")
    return F.when(F.contains(below, F.lit("=")),
                  F.regexp_replace(below, "(^|/)[^/=]*=", "$1")).otherwise(below)


def readable(path):
    """Names without ``.csv`` and with blanks for underscores."""
    return F.translate(F.replace(path, F.lit(".csv"), F.lit("")), "_", " ")


def parts_of(path):
    return F.split(path, "/")


def file_path_text(path):
    """The plain text of a file path that Spark reports percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def country_of(parts):
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(1)))


def state_of(parts):
    return F.when(F.size(parts) >= 4, F.get(parts, F.lit(2)))


def city_of(parts):
    name = F.element_at(parts, -1)
    return F.when(~name.rlike(fixed.GENERIC_FILE_NAME), name)


def clean_file_name(name):
    """A file name without its ending and noise; NULL for an area-wide file."""
    cleaned = F.replace(name, F.lit(".csv"), F.lit(""))
    for noise in fixed.FILE_NAME_NOISE:
        cleaned = F.replace(cleaned, F.lit(noise), F.lit(""))
    return F.when(~cleaned.isin(*fixed.AREA_FILE_NAMES), cleaned)


def folder_parents(parts):
    """Labels by folder level: country / state / city, for raw path parts.

    The file name takes the label of the level it lies on, and names nothing
    below the city level. The country always comes from the top folder.
    """
    depth = F.size(parts)
    file_name = clean_file_name(F.element_at(parts, -1))
    return F.struct(
        F.when(depth >= 2, F.get(parts, F.lit(0))).alias("country"),
        F.when(depth == 2, file_name).when(depth >= 3, F.get(parts, F.lit(1))).alias("state"),
        F.when(depth == 3, file_name).when(depth >= 4, F.get(parts, F.lit(2))).alias("city"))


def plain_location(path):
    """A file location Spark reported percent-encoded, as it was given."""
    return unquote(path)


# --- headers ----------------------------------------------------------------

def _folded(name):
    return re.sub("[ _]", "", name).upper()


FOLDED_LABELS = {_folded(name): label for name, label in fixed.HEADER_LABELS.items()}


def label_of_header(name):
    """The label of a column name, None where the column is dropped or unknown."""
    return FOLDED_LABELS.get(_folded(name)) or None


# --- record shapes ----------------------------------------------------------

def fields_map(columns):
    """Label columns to a map of the labels that are present."""
    entries = [part for name in columns for part in (F.lit(name), F.col(name).cast("string"))]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def label_value_list(pairs):
    """``(label, column)`` pairs to an ordered list of the values present."""
    listed = F.array(*[F.struct(F.lit(label).alias("label"), value.cast("string").alias("value"))
                       for label, value in pairs])
    return F.filter(listed, lambda pair: pair["value"].isNotNull())
