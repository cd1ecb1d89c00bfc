"""Structured records from source columns, headers, paths and parents."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import fields as fx
from labelweave.functions.binding import unfold


def positional_records(df, line="value"):
    """Raw CSV lines to the eleven positional columns; blank lines are dropped."""
    kept = df.filter(F.trim(line) != "")
    return (kept.withColumn("_row", fx.parse_line(F.col(line)))
            .select(*kept.columns, "_row.*"))


def clean_columns(df, columns=fixed.FILE_LABELS, strip_periods="fields"):
    """Periods removed and empty values made absent.

    ``fields`` keeps the coordinates intact, ``all`` strips them as well and
    ``none`` keeps every period.
    """
    def cleaned(name):
        value = F.col(name)
        keeps = strip_periods == "none" or (strip_periods == "fields" and name in ("lon", "lat"))
        return fx.empty_to_null(value if keeps else fx.strip_periods(value))

    return df.withColumns({name: cleaned(name) for name in columns if name in df.columns})


def rename_headers(df, keep=()):
    """Columns renamed to their labels, unknown ones dropped.

    Where two headers mean the same label the first non-empty value counts.
    """
    sources = {}
    for name in df.columns:
        label = fx.label_of_header(name)
        if label and name not in keep:
            sources.setdefault(label, []).append(fx.empty_to_null(F.col(f"`{name}`")))
    renamed = [F.coalesce(*columns).alias(label) for label, columns in sources.items()]
    return df.select(*keep, *renamed)


def plain_columns(df):
    """The column set of the plain format: coordinates and ids dropped, the
    rest renamed."""
    return df.drop(*fixed.PLAIN_DROPPED).withColumnsRenamed(fixed.PLAIN_RENAMED)


def with_path_fields(df, parts):
    """Country, state and city of the path fill in where the row has none."""
    def own(name):
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    return df.withColumns({
        "country": F.coalesce(own("country"), fx.country_of(parts)),
        "state": F.coalesce(own("state"), fx.state_of(parts)),
        "city": F.coalesce(own("city"), fx.city_of(parts)),
    })


def with_parents(df, parents):
    """Values that hold for a whole file or folder; the row's own value wins.

    ``parents`` maps a label to a column or to a constant.
    """
    def filled(label, value):
        value = value if hasattr(value, "cast") else F.lit(value)
        value = fx.empty_to_null(value.cast("string"))
        return F.coalesce(F.col(label), value) if label in df.columns else value

    return df.withColumns({label: filled(label, value) for label, value in parents.items()})


def with_folder_parents(df, parts):
    """Parents from the folder level: country, then state, then city."""
    parents = fx.folder_parents(parts)
    return with_parents(df, {label: parents[label] for label in ("country", "state", "city")})


def with_fields(df, labels=fixed.LABELS, name="fields"):
    """All label columns as one map of the labels present."""
    return df.withColumn(name, fx.fields_map([label for label in labels if label in df.columns]))


def with_pairs(df, labels=fixed.LABELS, name="pairs"):
    """All label columns as one ordered list of label/value pairs."""
    pairs = [(label, F.col(label)) for label in labels if label in df.columns]
    return df.withColumn(name, fx.label_value_list(pairs))


def unpivot_fields(df, key, labels=fixed.LABELS):
    """One row per present field."""
    listed = unfold(with_pairs(df, labels), [key], "pairs")
    return listed.select(key, "item.label", "item.value")
