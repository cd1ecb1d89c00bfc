"""Quality rules, the main one the frequency of lines across documents.

Lines are normalised and hashed, and the distinct documents that hold a line are
counted per host. Lines above the host's limit are boilerplate and are removed;
a document of which too little is left is rejected. Base rules reject texts that
are too short or repeat themselves. DataFrame functions only.
"""

from pyspark.sql import functions as F

from labelweave.llm.common import BLANKS, folded, let, table, whole_text, word_array, word_count
from labelweave.session import materialise

SYMBOLS = "#*$%&|<>"  # fixed by the contract
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A line is boilerplate in more documents of its host than both of these.
LINE_DOCUMENTS = 20
LINE_SHARE = 0.01
# A document is depleted if boilerplate takes more of its words than this.
DEPLETED_PERCENT = 50


def repeated_words(words):
    """Words inside three-word windows that occur twice or more, the first
    occurrence included. Windows are compared by 64-bit hash, sorted to meet
    their equals; overlapping windows count a word once."""
    def covered(h):
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = lambda s: F.sort_array(F.transform(F.filter(
            s, lambda x, i: (F.get(s, i - 1).h == x.h) | (F.get(s, i + 1).h == x.h)), lambda x: x.i))
        span = lambda a, p: F.struct(
            (a.n + p + WINDOW - F.greatest(p, a.end)).alias("n"), (p + WINDOW).alias("end"))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))
        return let(by_hash, lambda s: F.aggregate(starts(s), zero, span, lambda a: a.n))

    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    some = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))
    return let(words, lambda w: F.when(F.size(w) <= WINDOW, 0)
                .otherwise(let(windows(w), some))).cast("long")


def lines_with_words(text):
    return F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))


def base_rules(df, text="text"):
    """Adds the counts of the base rules and ``base_failed``."""
    whole = whole_text(text)
    lines = lines_with_words(whole)
    counted = df.withColumns({
        "n_words": word_count(whole),
        "word_chars": F.char_length(F.regexp_replace(whole, BLANKS, "")).cast("long"),
        "n_symbols": (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(word_array(whole))})
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def normalised(line):
    return F.lower(F.trim(F.regexp_replace(line, BLANKS, " ")))


def _hashed_lines(df, host):
    """A row per line with a word: document, host, position, words and two hashes."""
    # The digest goes into the rows: beside them, it would be computed for each line.
    lines = let(F.md5(whole_text()), lambda d: F.transform(
        F.split(whole_text(), "\n"), lambda line, i: F.struct(d.alias("digest"), i.alias("pos"), line.alias("line"))))
    norm = normalised(F.col("line"))
    return (df.select("doc_id", host, F.explode_outer(lines).alias("e")).select("doc_id", host, "e.*")
            .select("doc_id", host, "digest", "pos", word_count(F.col("line")).alias("words"),
                    F.xxhash64(host, norm).alias("h1"), F.hash(norm, host).alias("h2"))
            .where("words > 0"))


def frequent_lines(df, host="source", least=LINE_DOCUMENTS, share=LINE_SHARE):
    """Hashes of the lines above the limit of their host.

    Documents are distinct by text: exact copies count once, so that what was
    copied as a whole does not turn its lines into boilerplate. Every step
    combines before its shuffle, so a line of very many documents stays small.
    """
    lines = _hashed_lines(df, host)
    texts = (df.select(host, F.md5(whole_text()).alias("digest")).distinct()
             .groupBy(host).agg(F.count("*").alias("texts")))
    counted = (lines.select(host, "h1", "h2", "digest").distinct()
               .groupBy(host, "h1", "h2").agg(F.count("*").alias("documents")).where(F.col("documents") > least))
    return (counted.alias("c").join(texts.alias("t"), F.col(f"c.{host}").eqNullSafe(F.col(f"t.{host}")))
            .where(F.col("documents") > share * F.col("texts")).select("h1", "h2", "documents"))


def apply_rules(df, host="source"):
    """Adds the base counts, ``n_frequent_words``, ``kept`` and ``clean_text``.

    Null texts are empty, without words, and fail the base rules. A null host
    is a host. Rows equal in doc_id, host and text are one document and get one
    verdict. ``clean_text`` is the text without its frequent lines. Columns of
    these names are replaced; all others stay.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "n_frequent_words", "kept", "clean_text"]
    df = df.drop(*[n for n in names if n in df.columns])
    boilerplate = materialise(frequent_lines(df, host), "lines")
    found = (_hashed_lines(df, host).join(boilerplate, ["h1", "h2"])
             .groupBy("doc_id", host, "digest")
             .agg(F.collect_set(F.struct("pos", "words")).alias("__frequent"))
             .select(F.col("doc_id").alias("__id"), F.col(host).alias("__host"), F.col("digest").alias("__digest"),
                     "__frequent"))
    ruled = base_rules(df).withColumn("__md5", F.md5(whole_text()))
    joined = ruled.join(found, F.col("doc_id").eqNullSafe(F.col("__id"))
                        & F.col(host).eqNullSafe(F.col("__host")) & (F.col("__md5") == F.col("__digest")), "left")
    gone = F.transform("__frequent", lambda x: x.pos)
    rest = F.filter(F.split(whole_text(), "\n"), lambda line, i: ~F.array_contains(gone, i))
    judged = joined.withColumn("n_frequent_words", F.coalesce(F.aggregate(
        "__frequent", F.lit(0).cast("long"), lambda n, x: n + x.words), F.lit(0)))
    depleted = 100 * F.col("n_frequent_words") > DEPLETED_PERCENT * F.col("n_words")
    return (judged.withColumn("kept", ~F.col("base_failed") & ~depleted)
            .withColumn("clean_text", F.when(F.col("__frequent").isNull(), F.col("text"))
                        .otherwise(F.array_join(rest, "\n")))
            .drop("__id", "__host", "__digest", "__md5", "__frequent"))


def kept_documents(df, host="source"):
    """The rows of ``df`` that the rules keep, with all columns. Their frequent
    lines are taken out of the text, and ``n_chars``, if there is one, counts what
    is left of a text that lost some."""
    inner, unfold = folded(df, ["doc_id", "text", host])
    kept = apply_rules(inner, host).where("kept")
    if "n_chars" in df.columns:
        left = F.when(F.col("n_frequent_words") > 0, F.char_length("clean_text")).otherwise(F.col("__rest.n_chars"))
        kept = kept.withColumn("__rest", F.col("__rest").withField("n_chars", left))
    return unfold(kept.withColumn("text", F.col("clean_text")))


def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed", "kept", "n_frequent_words")


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
win as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)),
rep as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as p
        from (select *, count(*) over (partition by doc_id, g) as n from win) where n >= 2)
  group by doc_id),
line as (
  select doc_id, source, text, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as words,
         lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) as norm
  from (select *, unnest(string_split(text, chr(10))) as l from d)),
dup as (
  select doc_id, count(*) - count(distinct l) as n_dup_lines from line where words > 0 group by doc_id),
host as (select source, count(distinct text) as texts from d group by source),
often as (
  select line.source, norm from line join host on line.source is not distinct from host.source where words > 0
  group by line.source, norm, texts
  having count(distinct text) > 20 and count(distinct text) > 0.01 * texts),
gone as (
  select doc_id, sum(words) as n_frequent_words from line join often
  on line.norm = often.norm and line.source is not distinct from often.source where words > 0 group by doc_id),
c as (
  select w.doc_id, cast(len(words) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    cast(coalesce(n_frequent_words, 0) as bigint) as n_frequent_words
  from w left join dup using (doc_id) left join rep using (doc_id) left join gone using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and not 100 * n_frequent_words > 50 * n_words as kept
from c
"""
