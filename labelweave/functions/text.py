"""Free text: cleaning, words, sentences, n-grams, character ids and pieces."""

import string

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions.binding import let


# --- cleaning of messages -----------------------------------------------------

def drop_handles_and_urls(text):
    """A text with neither of the marks that a match begins with is passed on as it is."""
    marked = F.contains(text, F.lit("@")) | F.contains(text, F.lit("://"))
    return F.when(marked, F.regexp_replace(text, fixed.HANDLE_OR_URL, "")).otherwise(text)


def drop_www(text):
    return F.when(F.contains(text, F.lit("www")), F.regexp_replace(text, fixed.WWW, "")).otherwise(text)


def expand_negations(text):
    """Contracted negations written out. No expansion holds an apostrophe, so
    the replacements cannot meet each other and their order is free. Every
    contraction ends alike; a text without that ending is passed on as it is."""
    expanded = text
    for short, full in fixed.NEGATIONS.items():
        expanded = F.regexp_replace(expanded, rf"\b{short}\b", full)
    return F.when(F.contains(text, F.lit("n't")), expanded).otherwise(text)


# All code points that NOT_LETTER_OR_BLANK matches, without a negated class: Java
# searches that one many times more slowly.
_OTHERS = r"[\x00-\x1f!-@\[-`{-\x{10ffff}]"


def letters_only(text):
    """Letters and blanks; a removed line end joins its neighbours."""
    return F.trim(F.regexp_replace(text, _OTHERS, ""))


def clean_message(text):
    return letters_only(expand_negations(F.lower(drop_www(drop_handles_and_urls(text)))))


def message_words(text):
    """Lower case, split at every single whitespace: doubled blanks give empty words."""
    return F.split(F.lower(text), r"\s")


def ngrams(words, n):
    """Neighbouring words joined by blanks; none for a row shorter than ``n``.

    ``words`` is SQL text, as a rule a column name.
    """
    if n == 1:
        return F.expr(words)
    rest = ", ".join(f"w[i + {step}]" for step in range(1, n))
    listed = f"transform(slice(w, 1, size(w) - {n - 1}), (x, i) -> concat_ws(' ', x, {rest}))"
    return F.expr(let("w", words, f"if(size(w) >= {n}, {listed}, cast(array() as array<string>))"))


# --- documents, sentences and tokens ------------------------------------------

def document(text):
    """The whole text as one annotation with inclusive end."""
    return F.struct(F.lit("document").alias("annotatorType"), F.lit(0).alias("begin"),
                    (F.length(text) - 1).alias("end"), text.alias("result"))


# A sentence may start with marks; a text of marks only is a sentence too.
SENTENCE = r"[.!?]*[^.!?\s][^.!?]*[.!?]*|[.!?]+"
TOKEN = r"[A-Za-z0-9_À-ɏ]+|[^A-Za-z0-9_À-ɏ\s]"


def sentences(text):
    return F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), 0), lambda s: F.trim(s))


def tokens(sentence):
    """Runs of letters and digits, and single marks."""
    return F.regexp_extract_all(sentence, F.lit(TOKEN), 0)


def normalise_word(word):
    return F.lower(F.trim(word))


# --- character ids and sub-word pieces ------------------------------------------

# The 100 printable ASCII characters; the id of one is its place, from 1.
PRINTABLE = string.printable
UNKNOWN_CHARACTER = len(PRINTABLE) - 1


def character_ids(word):
    def to_id(character):
        place = F.instr(F.lit(PRINTABLE), character)
        return F.when(place > 0, place).otherwise(UNKNOWN_CHARACTER)

    return F.transform(F.split(word, ""), to_id)


def pieces(token, tag, width):
    """A word cut into pieces of so many characters: the first keeps the tag, the
    rest is marked."""
    return marked_pieces(F.regexp_extract_all(token, F.lit(f".{{1,{width}}}"), 0), tag)


def marked_pieces(cut, tag):
    return F.transform(cut, lambda piece, i: F.struct(
        piece.alias("piece"),
        F.when(i == 0, tag).otherwise(F.lit(fixed.PIECE_TAG)).alias("tag"),
        (i == 0).alias("is_word_start")))
