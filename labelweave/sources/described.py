"""Other address sources: geocoder results, XML lists, bilingual and free text."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import fields as fx

# Every spelling a component may have, mapped to its label.
_SPELLINGS = [(spelled, fx.label_of_header(name))
              for name in dict.fromkeys([c.upper() for c in fixed.COMPONENTS] + list(fixed.HEADER_LABELS))
              if fx.label_of_header(name) in fixed.COMPONENTS
              for spelled in (name.lower(), name)]


def geocoder_results(line):
    """Results of a JSON line, null where it cannot be read as such."""
    return F.from_json(line, "array<struct<components:map<string,string>>>")


def geocoder_pairs(line):
    """Known components of the first result of a JSON line, as label/value list."""
    components = F.get(geocoder_results(line), F.lit(0))["components"]
    return fx.label_value_list(
        [(label, F.try_element_at(components, F.lit(name))) for name, label in _SPELLINGS])


GEOCODER_FILES = "*inputdict.txt"


def _geocoder_lines(spark, paths, stream, files):
    reader = spark.readStream if stream else spark.read
    lines = reader.options(recursiveFileLookup="true", pathGlobFilter=files).text(paths)
    return lines.withColumn("_results", geocoder_results(F.col("value")))


def unreadable_geocoder_lines(spark, paths, stream=False, files=GEOCODER_FILES):
    """Path and text of the lines that hold no result of a geocoder."""
    lines = _geocoder_lines(spark, paths, stream, files).filter(F.coalesce(F.size("_results"), F.lit(0)) <= 0)
    return lines.select(F.col("_metadata.file_path").alias("path"), "value")


def read_geocoder_lines(spark, paths, stream=False, files=GEOCODER_FILES):
    """JSON lines of a geocoder, one pair list per line. Unreadable lines and
    lines without a result give nothing; see ``unreadable_geocoder_lines``."""
    lines = _geocoder_lines(spark, paths, stream, files).filter(F.size("_results") > 0)
    return lines.select(F.col("_metadata.file_path").alias("path"), "value",
                        geocoder_pairs(F.col("value")).alias("pairs"))


def flatten_json(df, column, schema, path, names):
    """Nested fields of a JSON text as plain columns."""
    parsed = df.withColumn("_json", F.from_json(F.col(column), schema))
    base = F.col(f"_json.{path}" if path else "_json")
    return parsed.select(*[c for c in df.columns if c != column],
                         *[base[name].alias(name) for name in names])


def read_xml_addresses(spark, paths, row_tag, schema):
    """Address elements of XML files without their tags."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(paths)


def split_bilingual(df, column, latin="english", han="chinese"):
    """The Latin and the Chinese share of a mixed text."""
    text = F.col(column)
    gap = F.regexp_replace(F.regexp_replace(text, r"\p{IsHan}+", " "), " +", " ")
    return df.withColumns({latin: fx.empty_to_null(F.trim(gap)),
                           han: fx.empty_to_null(F.regexp_replace(text, r"[^\p{IsHan}]+", ""))})


def parse_address_string(df, column, labels, sep=","):
    """A separated address string to fields by position, empty parts absent."""
    parts = F.split(F.col(column), sep)
    named = {label: fx.empty_to_null(F.trim(F.get(parts, F.lit(i))))
             for i, label in enumerate(labels)}
    return df.withColumns(named)


def literal_texts(spark, texts):
    """A one-column frame for ad-hoc scoring."""
    return spark.createDataFrame([(text,) for text in texts], "text string")


def read_messages(spark, paths, encoding="ISO-8859-1"):
    """Headerless message files; the columns are known."""
    schema = ", ".join(f"{name} string" for name in fixed.MESSAGE_COLUMNS)
    return (spark.read.schema(schema).option("encoding", encoding)
            .options(quote='"', escape='"').csv(paths))
