"""CoNLL corpora, stored annotations and entity dumps."""

from pyspark.sql import functions as F

from labelweave import fixed


def _blocks(spark, paths):
    """Blocks between blank lines. Files with plain line ends are split on read;
    blank lines with carriage returns or blanks in them separate blocks too."""
    read = (spark.read.option("lineSep", "\n\n").text(paths)
            .select("value", F.col("_metadata.file_path").alias("path"),
                    F.col("_metadata.file_block_start").alias("block_start")))
    split = F.split(F.replace("value", F.lit("\r"), F.lit("")), "\n[ \\t]*\n")
    return read.withColumn("value", F.explode(split)).withColumn(
        "doc_no", F.monotonically_increasing_id())


_LINES = ("filter(transform(split(value, '\\n'), line -> trim(line)), "
          f"line -> line <> '' and line <> '{fixed.DOCSTART}')")
_TOKENS = ("transform(transform({lines}, line -> split(line, ' ')), "
           "c -> struct(get(c, 0) as token, get(c, 1) as pos, element_at(c, -1) as tag))")


def read_conll(spark, paths):
    """One row per document: (token, pos, tag) structs and the text.

    Blank lines separate documents and serve as the record separator, so large
    files split and no line order across tasks matters. ``doc_no`` is unique
    within one read.
    """
    rows = _blocks(spark, paths).withColumn("tokens", F.expr(_TOKENS.format(lines=_LINES)))
    kept = rows.filter(F.size("tokens") > 0)
    return kept.select("path", "doc_no", F.array_join("tokens.token", " ").alias("text"),
                       "tokens")


def concatenate(spark, paths):
    """Document blocks of several corpora with the rank of their source.

    Sorting by (source_rank, path, block_start, doc_no) gives the order of the
    files laid end to end, those of one source by name.
    """
    ranked = None
    for rank, path in enumerate(paths):
        rows = _blocks(spark, path).withColumn("source_rank", F.lit(rank).cast("bigint"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    return ranked


def read_annotated(spark, paths):
    """Stored annotation parquet."""
    return spark.read.parquet(paths)


def fetch_entities(df, flag, columns):
    """Entities marked for training; the filter reaches the scan."""
    return df.filter(F.col(flag) == F.lit(True)).select(*columns)


_BODY = r"(?s)\{([^}]*)\}"


def repair_entity_text(body):
    """SQL text: the escaped CoNLL block inside one dumped entity, unescaped.

    Of the first two comma pieces the longer one is taken, the first on a tie;
    its value follows the first colon. The header and the token lines are
    separated by an escaped blank line, the lines by escaped line ends.
    """
    pieces = f"split({body}, ',')"
    longer = (f"if(length(coalesce(get({pieces}, 1), '')) > length(get({pieces}, 0)), "
              f"get({pieces}, 1), get({pieces}, 0))")
    value = f"get(split({longer}, ':'), 1)"
    return rf"split({value}, '\\\\n\\\\n')"


def read_entity_dump(spark, paths):
    """CoNLL blocks of a dumped entity table, one row per entity."""
    rows = spark.read.option("lineSep", fixed.ENTITY_MARK).text(paths)
    body = F.regexp_extract("value", _BODY, 1)
    named = rows.select("value", body.alias("body")).filter("body <> ''")
    halves = named.select(F.expr(repair_entity_text("body")).alias("halves"))
    header = F.ltrim(F.get("halves", F.lit(0)), F.lit(" '"))
    lines = F.transform(F.split(F.get("halves", F.lit(1)), r"\\n"),
                        lambda line: F.rtrim(line, F.lit("'")))
    return halves.select(F.concat(header, F.lit("\n\n"), F.array_join(lines, "\n"), F.lit("\n"))
                         .alias("block"))
