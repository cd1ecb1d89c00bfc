"""Text, tokens, BIO tags and offsets of an ordered address."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions.binding import let

# Prefix sums are taken in slices of this many tokens. Slices keep the work
# close to linear in the document length instead of quadratic.
_SLICE = 64
_SHORT = 16


def words(value):
    """Split on blank or underscore, empty words dropped.

    With one plain character to split at, no pattern is compiled per value.
    """
    one, other = fixed.TOKEN_SEPARATORS
    return F.array_remove(F.split(F.translate(value, other, one), one), "")


def part_words(parts):
    return F.transform(parts, lambda part: F.struct(
        part["label"].alias("label"), words(part["value"]).alias("words")))


def address_text(parts):
    """Raw values joined by blanks; an absent record gives an empty text."""
    return F.trim(F.array_join(F.transform(parts, lambda part: part["value"]), " "))


def token_text(tokens):
    """Tokens joined by single blanks, so that offsets always fit the text."""
    return F.array_join(tokens, " ")


def bio_tokens(worded):
    """Labelled tokens: the first word of a part opens it, the others continue it."""
    def of_part(part):
        return F.transform(part["words"], lambda word, index: F.struct(
            word.alias("token"),
            F.concat(F.when(index == 0, "B-").otherwise("I-"), part["label"]).alias("tag")))

    return F.flatten(F.transform(worded, of_part))


def tags_by_token(tagged):
    """Tags looked up by token text, where the last tag of a text wins.

    ``tagged`` is SQL text, as a rule a column name.
    """
    last = "element_at(filter(all, other -> other.token = item.token), -1).tag"
    body = f"transform(all, item -> struct(item.token as token, {last} as tag))"
    return F.expr(let("all", tagged, body))


def _running_sums(values, start):
    """Sums in front of each value, from ``start``."""
    grown = (f"aggregate({values}, array({start}), "
             "(sums, value) -> array_append(sums, element_at(sums, -1) + value))")
    return f"slice({grown}, 1, size({values}))"


def running_starts_text(tokens):
    sliced = (f"transform(sequence(0, cast((size(widths) - 1) div {_SLICE} as int)), "
              f"i -> slice(widths, i * {_SLICE} + 1, {_SLICE}))")
    totals = "transform(slices, s -> aggregate(s, 0, (sum, width) -> sum + width))"
    starts = f"flatten(transform(slices, (s, i) -> {_running_sums('s', 'bases[i]')}))"
    return let("widths", f"transform({tokens}, token -> length(token) + 1)",
               let("slices", sliced,
                   let("totals", totals, let("bases", _running_sums("totals", "0"), starts))))


def running_starts(tokens):
    """Start offset of every token in the blank-joined text.

    Exact for any length and without a shuffle. Short rows sum the widths in
    front of each token; in longer ones the offsets of whole slices are summed
    first, then those inside each slice. ``tokens`` is SQL text.
    """
    in_front = ("transform(widths, (width, i) -> "
                "aggregate(slice(widths, 1, i), 0, (sum, w) -> sum + w))")
    short = let("widths", f"transform({tokens}, token -> length(token) + 1)", in_front)
    return F.expr(f"if(size({tokens}) <= {_SHORT}, {short}, {running_starts_text(tokens)})")


def annotations(tagged, starts):
    """Annotation structs as they are stored: word as struct, double vector."""
    return F.transform(
        F.arrays_zip(tagged.alias("item"), starts.alias("start")),
        lambda z: F.struct(
            F.lit(fixed.ANNOTATION_TYPE).alias("annotatorType"),
            z["start"].alias("begin"),
            (z["start"] + F.length(z["item"]["token"]) - 1).alias("end"),
            z["item"]["tag"].alias("result"),
            F.struct(z["item"]["token"].alias("word")).alias("metadata"),
            F.array(F.lit(0.0)).alias("embeddings")))


def cast_annotations(label):
    """Stored annotations in the shape the tagger reads: word as map, float vector."""
    return F.transform(label, lambda a: F.struct(
        F.lit(fixed.ANNOTATION_TYPE).alias("annotatorType"),
        a["begin"].cast("int").alias("begin"),
        a["end"].cast("int").alias("end"),
        a["result"].alias("result"),
        F.create_map(F.lit("word"), a["metadata"]["word"]).alias("metadata"),
        F.array(F.lit(0.0).cast("float")).alias("embeddings")))


# --- plain format: a fixed list of columns ----------------------------------

def plain_text(columns):
    return F.concat_ws(" ", *columns)


def plain_tokens(columns):
    """Words of the present columns; doubled blanks leave empty words here."""
    values = F.filter(F.array(*columns), lambda value: value.isNotNull())
    return F.flatten(F.transform(values, lambda value: F.split(value, " ")))


def blank_split_count(value):
    return F.coalesce(F.size(F.split(value, " ")), F.lit(0))


def tags_from_count(count, label):
    """``count`` tags of one field; none for a count of zero."""
    opened = F.concat(F.array(F.lit(f"B-{label}")),
                      F.array_repeat(F.lit(f"I-{label}"), F.greatest(count - 1, F.lit(0))))
    return F.when(count > 0, opened).otherwise(F.array().cast("array<string>"))


def label_text(*tag_arrays):
    return F.array_join(F.concat(*tag_arrays), " ")


# --- CoNLL text ---------------------------------------------------------------

def conll_lines(tagged, pos):
    """``token pos pos tag`` lines, each with a blank and a line end behind."""
    lines = F.transform(
        F.arrays_zip(tagged.alias("item"), pos.alias("pos")),
        lambda z: F.concat_ws(" ", z["item"]["token"], z["pos"], z["pos"], z["item"]["tag"],
                              F.lit("\n")))
    return F.array_join(lines, "")


def collapse_docstarts(text):
    """Header lines that follow each other become one."""
    once = fixed.DOCSTART
    return F.regexp_replace(text, f"(?:{once}\\n\\n)+(?={once})", "")
