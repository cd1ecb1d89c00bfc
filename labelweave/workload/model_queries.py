"""Text classification (C) and token tagging (G)."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions.binding import unfold
from labelweave.functions import text as tx
from labelweave.operators import evaluate as ev
from labelweave.operators import tagger as tg
from labelweave.operators import textclass as tc
from labelweave.operators import tokens as tok
from labelweave.operators.sampling import with_split
from labelweave.plans import tagging
from labelweave.session import fresh_dir, materialise
from labelweave.sources import sinks
from labelweave.workload import sql, views
from labelweave.workload.registry import query

# --- C: text classification -------------------------------------------------------------------

_HANDLES = f"regexp_replace(text, {sql.quote(fixed.HANDLE_OR_URL)}, '', 'g')"
_NO_WWW = f"regexp_replace({_HANDLES}, {sql.quote(fixed.WWW)}, '', 'g')"


def _step_sql(expression):
    return f"with {sql.MESSAGES} select doc_id, {expression} as text from messages"


def _step(name, expression, steps):
    @query(name, _step_sql(expression))
    def run(spark, sf_dir):
        text = F.col("text")
        for step in steps:
            text = step(text)
        return views.messages(spark, sf_dir).select("doc_id", text.alias("text"))
    return run


c1 = _step("c1_drop_handles_and_urls", _HANDLES, [tx.drop_handles_and_urls])
c2 = _step("c2_drop_www", _NO_WWW, [tx.drop_handles_and_urls, tx.drop_www])
c3 = _step("c3_lower_case", f"lower({_NO_WWW})",
           [tx.drop_handles_and_urls, tx.drop_www, F.lower])


def _negations_sql(text):
    for short, full in fixed.NEGATIONS.items():
        word = sql.quote(f"\\b{short}\\b")
        text = f"regexp_replace({text}, {word}, {sql.quote(full)}, 'g')"
    return text


c4 = _step("c4_expand_negations", _negations_sql("lower(text)"), [F.lower, tx.expand_negations])
c5 = _step("c5_letters_only", sql.cleaned("text"), [tx.clean_message])


@query("c6_message_words", f"""with {sql.DOCUMENT_WORDS}
select doc_id, cast(unnest(range(0, len(w))) as bigint) as pos, unnest(w) as word from docwords""")
def c6(spark, sf_dir):
    return unfold(views.document_words(spark, sf_dir), ["doc_id"], "words", value="word")


_TURN_WORDS = f"""turnwords as (
  select conv_id, turn, regexp_split_to_array(lower({sql.cleaned('text')}), '\\s') as w
  from conversations)"""


@query("c7_ngrams", f"""with {_TURN_WORDS}, {sql.gram_rows('turnwords', 'conv_id, turn')}
select conv_id, turn, cast(n as bigint) as n, cast(pos as bigint) as pos, term from grams""")
def c7(spark, sf_dir):
    c = views.wide_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    words = c.select("conv_id", "turn",
                     tx.message_words(tx.clean_message(F.col("text"))).alias("words"))
    return tc.ngram_rows(words, "conv_id", "turn")


_VOCABULARY = f"""counts as (select n, term, count(*) as count from grams group by n, term),
vocabulary as (
  select n, term, count, row_number() over (partition by n order by count desc, term) - 1 as rank
  from counts qualify rank < {fixed.VOCABULARY_SIZE})"""


@query("c8_vocabulary", f"""with {sql.DOCUMENT_WORDS}, {sql.gram_rows()}, {_VOCABULARY}
select cast(n as bigint) as n, term, count, cast(rank as bigint) as rank from vocabulary""")
def c8(spark, sf_dir):
    # Three counts read the cleaned words: they are written once.
    return tc.vocabulary(materialise(views.document_words(spark, sf_dir), "words"))


_DOC_FREQ = """frequencies as (
  select g.n, g.term, count(distinct g.doc_id) as doc_freq
  from grams g join vocabulary v on g.n = v.n and g.term = v.term group by g.n, g.term)"""


@query("c9_idf", f"""with {sql.DOCUMENT_WORDS}, {sql.gram_rows()}, {_VOCABULARY}, {_DOC_FREQ}
select cast(n as bigint) as n, term, doc_freq,
       case when doc_freq >= {fixed.MIN_DOC_FREQ}
            then round(ln(((select count(*) from documents) + 1.0::double) / (doc_freq + 1)), 6)
            else 0.0 end as idf from frequencies""")
def c9(spark, sf_dir):
    words = materialise(views.document_words(spark, sf_dir), "words")
    idf = tc.inverse_document_frequency(words.count(), tc.vocabulary(words, doc_freq=True))
    return idf.withColumn("idf", F.round("idf", 6))


@query("c10_assembled_features",
       f"""with {sql.DOCUMENT_WORDS}, {sql.gram_rows()}, {_VOCABULARY}, {_DOC_FREQ}
select cast(n as bigint) as n, term, doc_freq from frequencies""")
def c10(spark, sf_dir):
    words = materialise(views.document_words(spark, sf_dir), "words")
    terms = materialise(tc.vocabulary(words), "vocabulary")
    return tc.feature_doc_freq(words, terms)


@query("c11_label_index", """
select 'lang' as source, lang as label, count(*) as count,
       row_number() over (order by count(*) desc, lang) - 1 as index from documents group by lang
union all
select 'event_type', event_type, count(*),
       row_number() over (order by count(*) desc, event_type) - 1 from events group by event_type""")
def c11(spark, sf_dir):
    d = tc.label_index(views.table(spark, sf_dir, "documents"), "lang")
    e = tc.label_index(views.table(spark, sf_dir, "events"), "event_type")
    return (d.select(F.lit("lang").alias("source"), "*")
            .unionByName(e.select(F.lit("event_type").alias("source"), "*")))


def _classified(spark, sf_dir):
    docs = with_split(views.labelled_documents(spark, sf_dir), "doc_id")
    model, rows = tc.fit_with_rows(docs.filter("split = 'train'"))
    return model, rows, docs.filter("split = 'test'")


_SPLIT_LABELS = f"""split as (
  select doc_id, quality::varchar as sentiment,
         {sql.draw('doc_id', 'split')} < 0.8 as training
  from documents join labels using (doc_id)),
indexed as (select sentiment, row_number() over (order by count(*) desc, sentiment) - 1 as i
            from split where training group by sentiment)"""


@query("c12_text_classifier", f"""with {_SPLIT_LABELS}
select doc_id, s.sentiment, i::double as label, true as has_learned
from split s join indexed x on s.sentiment = x.sentiment where not training""")
def c12(spark, sf_dir):
    """The held-out rows, and whether the model tells the rows it learned from
    better than the most frequent label does. The labels of the given tables do
    not follow from their texts, so the held-out rows cannot tell."""
    model, learned, held_out = _classified(spark, sf_dir)
    right = F.sum(F.when(F.col("label") == F.col("prediction"), 1).otherwise(0))
    per_label = model.stages[-1].transform(learned).groupBy("label").agg(F.count(F.lit(1)).alias("n"), right.alias("right"))
    verdict = per_label.agg((F.sum("right") > F.max("n")).alias("has_learned"))  # one row
    return tc.classify(model, held_out).select("doc_id", "sentiment", "label").join(verdict)


@query("c13_fit_and_transform", f"""with {_SPLIT_LABELS}
select doc_id, s.sentiment, i::double as label, true as follows_from_model
from split s join indexed x on s.sentiment = x.sentiment where not training""")
def c13(spark, sf_dir):
    """Predictions and probabilities against the margins of the model's own
    coefficients."""
    model, _, held_out = _classified(spark, sf_dir)
    margin = tc.margins(model)(vector_to_array("features"))
    likely = 1 / (1 + F.exp(-margin))
    follows = (((margin > 0).cast("double") == F.col("prediction"))
               & (F.abs(F.get(vector_to_array("probability"), F.lit(1)) - likely) < 1e-9))
    return tc.classify(model, held_out).select("doc_id", "sentiment", "label", follows.alias("follows_from_model"))


@query("c14_accuracy", """
select count(*) as total, cast(sum((quality = toxic)::int) as bigint) as correct,
       round(avg((quality = toxic)::int)::double, 6) as accuracy from labels""")
def c14(spark, sf_dir):
    q = views.table(spark, sf_dir, "labels")
    return ev.accuracy(q, "quality", "toxic").withColumn("accuracy", F.round("accuracy", 6))


@query("c15_reload_parity", f"""
select count(*) as n_rows, cast(0 as bigint) as n_changed
from documents join labels using (doc_id)
where {sql.draw('doc_id', 'split')} >= 0.8""")
def c15(spark, sf_dir):
    model, _, held_out = _classified(spark, sf_dir)
    path = fresh_dir(spark, "classifier")
    sinks.save_model(model, path)
    columns = ["doc_id", "prediction"]
    before = tc.classify(model, held_out).select(*columns)
    after = tc.classify(tc.load_classifier(path), held_out).select(
        "doc_id", F.col("prediction").alias("again"))
    changed = (F.col("prediction") != F.col("again")).cast("bigint")
    return before.join(after, "doc_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.sum(changed).alias("n_changed"))


# --- G: token tagging ----------------------------------------------------------------------------

@query("g1_token_vectors", sql.labelled() + """
select token, cast(16 as bigint) as width from tokens group by token having count(*) >= 3""")
def g1(spark, sf_dir):
    words = views.plain_labelled(spark, sf_dir).select(F.col("tokens.token").alias("words"))
    vectors = tg.token_vectors(words, min_count=3).getVectors()
    width = F.size(tg.vector_to_array("vector")).cast("bigint")
    return vectors.select(F.col("word").alias("token"), width.alias("width"))


@query("g2_context_features", sql.labelled() + """
select key, cast(pos as bigint) as pos, token, tag, lower(token) as word,
       regexp_replace(regexp_replace(regexp_replace(token, '[A-Z]+', 'X', 'g'),
                      '[a-z]+', 'x', 'g'), '[0-9]+', '9', 'g') as shape,
       lower(token)[1:2] as prefix, right(lower(token), 2) as suffix,
       coalesce(lower(lag(token) over w), '<start>') as previous,
       coalesce(lower(lead(token) over w), '<end>') as next,
       case when pos = 0 then 'first' when lead(token) over w is null then 'last'
            else 'inner' end as place
from tokens window w as (partition by key order by pos)""")
def g2(spark, sf_dir):
    return tg.context_rows(views.plain_labelled(spark, sf_dir), "key")


def _trained(spark, sf_dir):
    labelled = with_split(views.plain_labelled(spark, sf_dir), "key")
    tagger = tagging.train(labelled.filter("split = 'train'"))
    return tagger, labelled.filter("split = 'test'")


_HELD_OUT = f"{sql.draw('key', 'split')} >= 0.8"


@query("g3_tagger_scores", sql.labelled() + f"""
select count(*) as total, true as beats_most_frequent_tag from tokens where {_HELD_OUT}""")
def g3(spark, sf_dir):
    tagger, held_out = _trained(spark, sf_dir)
    rows = tagging.score(tagger, held_out)
    per_tag = rows.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("target") == F.col("prediction"), 1).otherwise(0)).alias("right"))
    return per_tag.agg(F.sum("n").alias("total"),
                       (F.sum("right") > F.max("n")).alias("beats_most_frequent_tag"))


@query("k10_model_save_and_load", sql.labelled() + f"""
select count(*) as n_tokens, cast(0 as bigint) as n_changed from tokens where {_HELD_OUT}""")
def k10(spark, sf_dir):
    tagger, held_out = _trained(spark, sf_dir)
    path = fresh_dir(spark, "tagger")
    tagger.save(spark, path)
    columns = ["key", "pos"]
    before = tagging.score(tagger, held_out).select(*columns, "prediction")
    after = tagging.score(tagging.Tagger.load(spark, path), held_out).select(
        *columns, F.col("prediction").alias("again"))
    changed = F.when(F.col("prediction") == F.col("again"), 0).otherwise(1)
    return before.join(after, columns).agg(F.count(F.lit(1)).alias("n_tokens"),
                                           F.sum(changed).cast("bigint").alias("n_changed"))


_TRANSITIONS = """pairs as (
  select coalesce(lag(tag) over (partition by key order by pos), '<start>') as previous, tag
  from tokens),
transitions as (
  select previous, tag, count(*) as n, sum(count(*)) over (partition by previous) as total
  from pairs group by previous, tag)"""


@query("g4_tag_order", sql.labelled(_TRANSITIONS) + """
select previous, tag, n, cast(total as bigint) as total,
       round(ln((n + 1.0::double) / (total + (select count(distinct tag) from tokens)::double)), 6) as log_probability
from transitions""")
def g4(spark, sf_dir):
    counts = tg.transition_counts(views.plain_labelled(spark, sf_dir), "tokens.tag")
    n_tags = tok.tag_set(views.tag_rows(spark, sf_dir)).count()
    return tg.transition_scores(counts, n_tags).withColumn(
        "log_probability", F.round("log_probability", 6))


_DECODE = """tagset as (select tag, row_number() over (order by tag) as id
           from (select distinct tag from tokens)),
n_tags as (select count(*)::double as t from tagset),
moves as (
  select a.tag as previous, b.tag, ln((coalesce(x.n, 0) + 1.0::double)
         / (coalesce((select max(total) from transitions y where y.previous = a.tag), 0) + t)) as s
  from (select tag from tagset union all select '<start>') a, tagset b, n_tags
  left join transitions x on x.previous = a.tag and x.tag = b.tag),
uses as (select token, tag, count(*) as n from tokens group by token, tag),
totals as (select token, sum(n) as total from uses group by token),
emissions as (
  select k.key, k.pos, g.tag, g.id,
         ln((coalesce(u.n, 0) + 1.0::double) / (w.total + t)) as e
  from tokens k join totals w on k.token = w.token cross join tagset g cross join n_tags
  left join uses u on u.token = k.token and u.tag = g.tag),
best as (
  select e.key, 0::bigint as pos, e.tag, e.e + m.s as score, [e.tag] as path
  from emissions e join moves m on m.previous = '<start>' and m.tag = e.tag where e.pos = 0
  union all
  select b.key, b.pos + 1, e.tag, max(b.score + m.s) + any_value(e.e),
         list_append(arg_max(b.path, b.score + m.s), e.tag)
  from best b join emissions e on e.key = b.key and e.pos = b.pos + 1
  join moves m on m.previous = b.tag and m.tag = e.tag
  group by b.key, b.pos, e.tag),
final as (
  select b.key, arg_max(b.path, b.score) as path
  from best b join (select key, max(pos) as last from tokens group by key) l
       on b.key = l.key and b.pos = l.last group by b.key)
select key, cast(unnest(range(0, len(path))) as bigint) as pos, unnest(path) as tag from final"""


@query("g5_best_path", sql.labelled(_TRANSITIONS) + "," + _DECODE)
def g5(spark, sf_dir):
    base = views.plain_labelled(spark, sf_dir)
    rows = views.tag_rows(spark, sf_dir)
    names = sorted(row["tag"] for row in tok.tag_set(rows).collect())  # one row per tag
    start, moves = tg.transition_matrix(tg.transition_counts(base, "tokens.tag"), names)
    emitted = tg.count_emissions(rows.select("key", "pos", "token"), rows, names)
    decoded = tg.decode_rows(emitted, ["key"], names, start, moves)
    return unfold(decoded, ["key"], "tokens.tag", value="tag")


_ODD_TEXTS = ((-1, ""), (-2, None), (-3, "?!"), (-4, "70 York St. Toronto Ontario"), (-5, "...Main Road"),
              (-6, "70 York St. Toronto Ontario"))
_ODD_SQL = ", ".join(f"({k}, {'null' if t is None else sql.quote(t)})" for k, t in _ODD_TEXTS)
_FREE = f"""texts as (
  select key, string_agg(token, ' ' order by pos) as text from tokens group by key
  union all select * from (values {_ODD_SQL}) odd(key, text)),
free as (
  select key, unnest(range(0, len(t))) as pos, unnest(t) as token
  from (select key, regexp_extract_all(text, {sql.quote(tx.TOKEN)}) as t from texts))"""
_FREE_DECODE = (_DECODE.replace("from tokens k join totals", "from free k left join totals")
                .replace("(w.total + t)", "(coalesce(w.total, 0) + t)")
                .replace("(select key, max(pos) as last from tokens", "(select key, max(pos) as last from free")
                .rpartition("select key, cast(unnest(range")[0].rstrip())
_RECORDS = """predicted as (
  select f.key, f.pos, f.token, p.path[f.pos + 1] as tag from free f join final p on f.key = p.key),
islands as (
  select *, sum((tag like 'B-%')::int) over (partition by key order by pos) as island from predicted),
chunks as (
  select key, island, arg_min(substr(tag, 3), pos) as label, string_agg(token, ' ' order by pos) as chunk
  from islands where island > 0 and (tag like 'B-%' or tag like 'I-%') group by key, island)"""
_LAST = ", ".join(f"arg_max(chunk, island) filter (label = '{label}') as {label}" for label in fixed.LABELS)


def _counted_tags(spark, sf_dir):
    """Emissions by counts, tags and their order, learned on all labelled rows."""
    rows = views.tag_rows(spark, sf_dir)
    names = sorted(row["tag"] for row in tok.tag_set(rows).collect())  # one row per tag
    counts = tg.transition_counts(views.plain_labelled(spark, sf_dir), "tokens.tag")
    start, moves = tg.transition_matrix(counts, names)
    return (lambda tokens: tg.count_emissions(tokens, rows, names)), names, start, moves


@query("g6_predict_records", sql.labelled(_TRANSITIONS) + "," + ",\n".join([_FREE, _FREE_DECODE, _RECORDS]) + f"""
select t.key, t.text, {', '.join('w.' + label for label in fixed.LABELS)}
from texts t left join (select key, {_LAST} from chunks group by key) w on t.key = w.key""")
def g6(spark, sf_dir):
    texts = views.plain_labelled(spark, sf_dir).select("key", "text").unionByName(
        spark.createDataFrame(_ODD_TEXTS, "key bigint, text string"))
    tagged = tagging.with_tagged_tokens(tagging.tokenise_texts(texts), *_counted_tags(spark, sf_dir))
    return tagging.records_of(tagged, "key")


@query("g7_softmax_threshold", """
with scores as (select vec_id, embedding as v from embeddings),
shares as (
  select vec_id, unnest(range(0, len(v))) as pos, unnest(v) as s,
         list_reduce(list_transform(v, lambda x: exp(x::double)), lambda a, b: a + b) as total
  from scores)
select vec_id, cast(pos as bigint) as pos,
       round(case when exp(s::double) / total >= 0.02 then exp(s::double) / total else 0 end, 6)
         as probability
from shares""")
def g7(spark, sf_dir):
    e = views.table(spark, sf_dir, "embeddings")
    scores = e.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    soft = scores.select("vec_id", F.posexplode(tg.softmax("v", 0.02)).alias("pos", "p"))
    return soft.select("vec_id", F.col("pos").cast("bigint").alias("pos"),
                       F.round("p", 6).alias("probability"))


_TEXTS = f"""sentences as (
  select concat_ws('-', lpad(conv_id::varchar, 19, '0'), lpad(turn::varchar, 19, '0'),
                   lpad(unnest(range(0, len(s)))::varchar, 10, '0')) as key, unnest(s) as sentence
  from (select conv_id, turn, list_transform(regexp_extract_all(text, {sql.quote(tx.SENTENCE)}),
                                             lambda x: trim(x)) as s from conversations)),
lengths as (
  select key, t, len(t) as n,
         case when len(t) <= 5 then 0 when len(t) <= 10 then 1 when len(t) <= 20 then 2
              when len(t) <= 50 then 3 else 4 end as bucket
  from (select key, regexp_extract_all(sentence, {sql.quote(tx.TOKEN)}) as t from sentences)),
batched as (
  select *, (row_number() over (partition by bucket order by key) - 1) // 8 as batch
  from lengths)"""


def _sentences(spark, sf_dir):
    c = tok.with_sentences(views.wide_table(spark, sf_dir, "conversations", "conv_id", "turn", "text"))
    rows = tok.sentence_rows(c, "conv_id", "turn")
    key = F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), n, "0") for c, n in (
        ("conv_id", 19), ("turn", 19), ("sentence_no", 10))])
    split = rows.select(key.alias("key"), tx.tokens(F.col("sentence")).alias("words"))
    return split.withColumn("bucket", tok.length_bucket(F.size("words")))


@query("g8_length_bucket", f"with {_TEXTS} select key, cast(bucket as bigint) as bucket from lengths")
def g8(spark, sf_dir):
    return _sentences(spark, sf_dir).select("key", "bucket")


def _batched(spark, sf_dir):
    return tok.with_batches(_sentences(spark, sf_dir), "key", "bucket", 8)


@query("g9_batches", f"""with {_TEXTS}
select key, cast(bucket as bigint) as bucket, cast(batch as bigint) as batch from batched""")
def g9(spark, sf_dir):
    return _batched(spark, sf_dir).select("key", "bucket", "batch")


@query("g10_pad_to_batch", f"""with {_TEXTS},
widths as (select key, list_transform(t, lambda x: length(x)) as w, n,
                  max(n) over (partition by bucket, batch) as m from batched)
select key, array_to_string(list_concat(w, list_transform(range(0, m - n), lambda x: 0)), ',')
         as padded from widths""")
def g10(spark, sf_dir):
    rows = _batched(spark, sf_dir)
    widths = rows.withColumn("w", F.transform("words", lambda word: F.length(word)))
    padded = tok.pad_to_batch(widths, ["bucket", "batch"], "w")
    return padded.select("key", F.array_join(F.col("w").cast("array<string>"), ",")
                         .alias("padded"))


@query("g10_pad_characters", f"""with {_TEXTS},
sizes as (select key, bucket, batch, n, list_max(list_transform(t, lambda x: length(x))) as c,
                 list_sum(list_transform(t, lambda x: length(x))) as filled from batched)
select key, max(n) over w as n_words, cast(max(c) over w as bigint) as n_characters,
       cast(filled as bigint) as n_filled
from sizes window w as (partition by bucket, batch)""")
def g10_characters(spark, sf_dir):
    rows = _batched(spark, sf_dir)
    ids = rows.withColumn("c", F.transform("words", tx.character_ids))
    padded = tok.pad_nested_to_batch(ids, ["bucket", "batch"], "c")
    inner = F.transform("c", lambda x: F.size(x))
    filled = F.size(F.filter(F.flatten("c"), lambda x: x > 0))
    same = F.when(F.array_min(inner) == F.array_max(inner), F.array_max(inner))
    return padded.select("key", F.size("c").cast("bigint").alias("n_words"),
                         same.cast("bigint").alias("n_characters"),
                         filled.cast("bigint").alias("n_filled"))


@query("g11_merge_pieces", sql.labelled() + """
select key, cast(pos as bigint) as pos, token[1:4] as piece, tag from tokens""")
def g11(spark, sf_dir):
    pieces = tok.encode_pieces(views.tag_rows(spark, sf_dir), "key", "pos")
    return tok.word_starts(pieces).select("key", "pos", "piece", "tag")
