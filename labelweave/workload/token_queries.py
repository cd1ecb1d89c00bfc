"""Sentences, tokens, dictionaries, samples, scores and spans (T13 to T23, P, E, W, G7 to G11)."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import draws
from labelweave.functions import text as tx
from labelweave.operators import evaluate as ev
from labelweave.operators import labelling as lab
from labelweave.operators import sampling as smp
from labelweave.operators import subwords as sw
from labelweave.operators import tokens as tok
from labelweave.operators import wide
from labelweave.session import materialise
from labelweave.workload import sql, views
from labelweave.workload.registry import query

_SENTENCE = sql.quote(tx.SENTENCE)
_TOKEN = sql.quote(tx.TOKEN)

# --- T13 to T18: documents, sentences, tokens ------------------------------------------

_DOC_TOKENS = f"""doctokens as (
  select doc_id, lang, unnest(regexp_extract_all(text, {_TOKEN})) as token from documents)"""


@query("t13_most_frequent_tag", f"""with {_DOC_TOKENS},
counts as (select token, lang, count(*) as n from doctokens group by token, lang),
lexicon as (select token, lang as pos_tag from counts
            qualify row_number() over (partition by token order by n desc, lang) = 1),
turns as (
  select conv_id, turn, unnest(t) as token, unnest(range(0, len(t))) as pos
  from (select conv_id, turn, regexp_extract_all(text, {_TOKEN}) as t from conversations))
select conv_id, turn, cast(pos as bigint) as pos, token, coalesce(pos_tag, 'NN') as pos_tag
from turns left join lexicon using (token)""")
def t13(spark, sf_dir):
    d = views.wide_table(spark, sf_dir, "documents", "text", "lang")
    training = d.select(F.explode(tx.tokens(F.col("text"))).alias("token"),
                        F.col("lang").alias("tag"))
    c = views.wide_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    rows = tok.sentence_token_rows(c, "conv_id", "turn", sentence="text")
    return tok.apply_lexicon(rows, tok.fit_lexicon(training)).select(
        "conv_id", "turn", "pos", "token", "pos_tag")


@query("t13_unknown_tokens", f"""with {_DOC_TOKENS},
told as (select *, {sql.draw('doc_id', 'split')} < 0.8 as training from doctokens),
kinds as (select distinct token, lang as tag from told where training and lang is not null),
endings as (
  select tag, right(lower(token), k) as suffix
  from (select *, unnest(range(0, least(4, length(lower(token))) + 1)) as k from kinds)),
counts as (select suffix, tag, count(*) as n from endings group by suffix, tag),
suffixes as (
  select suffix, arg_min(tag, struct_pack(o := -n, t := tag)) as pos_tag from counts
  group by suffix having sum(n) >= 2 or suffix = ''),
unknown as (
  select distinct token from told where not training and token not in (select token from kinds))
select token, arg_max(pos_tag, length(suffix)) as pos_tag
from (select token, unnest(range(0, least(4, length(lower(token))) + 1)) as k from unknown) u
join suffixes on suffix = right(lower(token), k) group by token""")
def t13_unknown(spark, sf_dir):
    """Tags, here languages, of the tokens that no training document has."""
    d = smp.with_split(views.wide_table(spark, sf_dir, "documents", "doc_id", "text", "lang"), "doc_id")
    rows = materialise(d.select("split", F.explode(tx.tokens(F.col("text"))).alias("token"), F.col("lang").alias("tag"))
                       .distinct(), "tokens")
    training = rows.where("split = 'train' and tag is not null")
    lexicon = tok.fit_lexicon(training)
    return tok.guess_tags(rows.where("split = 'test'"), lexicon, tok.fit_suffixes(training))


@query("t14_document_annotation", """
select doc_id, 'document' as annotator_type, cast(0 as bigint) as "begin",
       cast(length(text) - 1 as bigint) as "end", text as result from documents""")
def t14(spark, sf_dir):
    d = tok.with_document(views.table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.col("document.annotatorType").alias("annotator_type"),
                    F.col("document.begin").cast("bigint").alias("begin"),
                    F.col("document.end").cast("bigint").alias("end"),
                    F.col("document.result").alias("result"))


_SENTENCES = f"""sentences as (
  select doc_id, unnest(s) as sentence, unnest(range(0, len(s))) as sentence_no
  from (select doc_id, list_transform(regexp_extract_all(text, {_SENTENCE}),
                                      lambda x: trim(x)) as s from documents))"""


def _sentence_rows(spark, sf_dir):
    d = tok.with_sentences(views.wide_table(spark, sf_dir, "documents", "doc_id", "text"))
    return tok.sentence_rows(d, "doc_id")


@query("t15_sentence_split", f"""with {_SENTENCES}
select doc_id, cast(sentence_no as bigint) as sentence_no, sentence from sentences""")
def t15(spark, sf_dir):
    return _sentence_rows(spark, sf_dir)


@query("t16_sentence_tokens", f"""with {_SENTENCES},
split as (select doc_id, sentence_no, regexp_extract_all(sentence, {_TOKEN}) as t from sentences)
select doc_id, cast(sentence_no as bigint) as sentence_no, unnest(t) as token,
       cast(unnest(range(0, len(t))) as bigint) as pos from split""")
def t16(spark, sf_dir):
    return tok.sentence_token_rows(_sentence_rows(spark, sf_dir), "doc_id", "sentence_no")


@query("t17_single_sentence_rows", f"""
select doc_id, cast(-1 as bigint) as turn, text from documents where len(regexp_extract_all(text, {_SENTENCE})) <= 1
union all
select item_id, -1, text from benchmark where len(regexp_extract_all(text, {_SENTENCE})) <= 1
union all
select conv_id, turn, text from conversations
where len(regexp_extract_all(text, {_SENTENCE})) <= 1""")
def t17(spark, sf_dir):
    none = F.lit(-1).cast("bigint").alias("turn")
    d = views.wide_table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", none, "text")
    b = views.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), none, "text")
    c = views.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", "text")
    texts = tok.with_sentences(d.unionByName(b).unionByName(c))
    return tok.single_sentence_rows(texts).select("doc_id", "turn", "text")


def _arrays(spark, sf_dir):
    """Token, truth and prediction arrays; the prediction has one entry more."""
    rows = views.predicted_tokens(spark, sf_dir)
    truth = views.plain_labelled(spark, sf_dir)
    truth = truth.select("key", F.transform("tokens", lambda t: t["tag"]).alias("targets"))
    rows = rows.select("key", F.transform("tokens", lambda t: t["token"]).alias("tokens"),
                       F.concat(F.transform("tokens", lambda t: t["tag"]), F.array(F.lit("X")))
                       .alias("predictions"))
    return rows.join(truth, "key")


_PADDED = """padded as (
  select key, pos, token, target, prediction from predicted
  union all select key, max(pos) + 1, null, null, 'X' from predicted group by key)"""


@query("t18_token_rows", sql.labelled(sql.PREDICTED, _PADDED) + """
select key, cast(pos as bigint) as pos, token, target, prediction from padded""")
def t18(spark, sf_dir):
    return ev.side_by_side(_arrays(spark, sf_dir), "key")


@query("t19_word_normalise", f"""with {_DOC_TOKENS}
select lower(trim(' ' || token || ' ')) as word, count(*) as n from doctokens group by 1""")
def t19(spark, sf_dir):
    d = views.wide_table(spark, sf_dir, "documents", "text")
    words = d.select(F.explode(tx.tokens(F.col("text"))).alias("token"))
    padded = F.concat(F.lit(" "), "token", F.lit(" "))
    return words.groupBy(tx.normalise_word(padded).alias("word")).agg(
        F.count(F.lit(1)).alias("n"))


_PRINTABLE = sql.quote(tx.PRINTABLE)


@query("t20_character_ids", sql.labelled() + f""",
chars as (select key, pos, unnest(string_split(token || 'é', '')) as c,
                 unnest(range(0, length(token) + 1)) as char_no from tokens)
select key, cast(pos as bigint) as pos, cast(char_no as bigint) as char_no,
       cast(case when strpos({_PRINTABLE}, c) > 0 then strpos({_PRINTABLE}, c) else 99 end
            as bigint) as char_id from chars""")
def t20(spark, sf_dir):
    rows = views.tag_rows(spark, sf_dir).withColumn("token", F.concat("token", F.lit("é")))
    listed = rows.select("key", "pos", F.posexplode(tx.character_ids(F.col("token")))
                         .alias("char_no", "char_id"))
    return listed.select("key", "pos", F.col("char_no").cast("bigint").alias("char_no"),
                         F.col("char_id").cast("bigint").alias("char_id"))


_DICTIONARY = """dictionary as (
  select 'O' as tag, cast(0 as bigint) as tag_id
  union all
  select tag, cast(row_number() over (order by f.key, f.pos) as bigint)
  from (select target as tag, min({'key': key, 'pos': pos}) as f from predicted
        where target <> 'O' group by target))"""


@query("t21_tag_dictionary", sql.labelled(sql.PREDICTED, _DICTIONARY) + """
select p.key, cast(p.pos as bigint) as pos, p.prediction as tag, d.tag_id
from predicted p left join dictionary d on p.prediction = d.tag""")
def t21(spark, sf_dir):
    rows = views.predicted_rows(spark, sf_dir)
    ids = tok.tag_dictionary(rows, "key", "pos", tag="target")
    return tok.with_tag_ids(rows, ids, tag="prediction").select(
        "key", "pos", F.col("prediction").alias("tag"), "tag_id")


_PIECES = """cut as (
  select key, pos, tag, regexp_extract_all(token, '.{1,4}') as p from tokens),
pieces as (
  select key, pos, tag, unnest(p) as piece, unnest(range(0, len(p))) as piece_no from cut)"""


@query("t22_piece_alignment", sql.labelled(_PIECES) + """
select key, cast(pos as bigint) as pos, cast(piece_no as bigint) as piece_no, piece,
       case when piece_no = 0 then tag else '[X]' end as tag, piece_no = 0 as is_word_start
from pieces""")
def t22(spark, sf_dir):
    rows = views.tag_rows(spark, sf_dir)
    return tok.encode_pieces(rows.select("key", "pos", "token", "tag"), "key", "pos")


_ROUNDS, _PER_ROUND = 3, 8


def _learned_sql():
    rounds = """spellings as (select token as w, count(*) as n from tokens where token <> '' group by token),
state0 as (select w, n, regexp_replace(w, '(.)', chr(1) || '\\1' || chr(2), 'g') as state from spellings)"""
    for i in range(_ROUNDS):
        rounds += f""",
symbols{i} as (select n, regexp_extract_all(state, chr(1) || '([^' || chr(2) || ']*)' || chr(2), 1) as s from state{i}),
pairs{i} as (
  select s[j] as a, s[j + 1] as b, sum(n) as n from (select s, n, unnest(range(1, len(s))) as j from symbols{i})
  group by 1, 2 having sum(n) >= 2),
first{i} as (
  select a, b, n from (select *, unnest(list_distinct([a, b])) as symbol from pairs{i})
  qualify row_number() over (partition by symbol order by n desc, a, b) = 1),
chosen{i} as materialized (
  select a, b, any_value(n) as n from first{i} group by a, b having count(*) = case when a = b then 1 else 2 end
  order by any_value(n) desc, a, b limit {_PER_ROUND}),
state{i + 1} as materialized (
  select w, n, list_reduce([state] || (select coalesce(list(
      chr(1) || a || chr(2) || chr(1) || b || chr(2) || chr(3) || chr(1) || a || b || chr(2) order by chosen{i}.n desc, a, b), [])
      from chosen{i}),
    lambda x, y: replace(x, string_split(y, chr(3))[1], string_split(y, chr(3))[2])) as state
  from state{i})"""
    merges = " ".join(f"union select a || b from chosen{i}" for i in range(_ROUNDS))
    return rounds + f""",
vocabulary as materialized (select unnest(string_split(w, '')) as piece from spellings {merges}),
cuts as (
  select w, 0 as piece_no, cast(1 as bigint) as here, '' as piece from spellings
  union all
  select w, piece_no + 1, here + len(best), best from (
    select c.w, c.piece_no, c.here, arg_max(v.piece, len(v.piece)) as best
    from cuts c join vocabulary v on starts_with(substr(c.w, c.here), v.piece)
    where c.here <= len(c.w) group by c.w, c.piece_no, c.here))"""


@query("t22_learned_pieces", sql.labelled(_learned_sql()) + """
select key, cast(pos as bigint) as pos, cast(piece_no - 1 as bigint) as piece_no, piece,
       case when piece_no = 1 then tag else '[X]' end as tag, piece_no = 1 as is_word_start
from tokens join cuts on token = w where piece_no > 0""")
def t22_learned(spark, sf_dir):
    rows = views.tag_rows(spark, sf_dir)
    pattern = sw.prefix_pattern(sw.learn_pieces(rows, _ROUNDS, _PER_ROUND, word="token"))
    return tok.encode_learned(rows.select("key", "pos", "token", "tag"), "key", "pos", pattern=pattern)


@query("t23_corpus_profile", sql.labelled() + """
select 'n_tags' as name, count(distinct tag) as value from tokens
union all select 'embedding_width', max(len(embedding)) from embeddings
union all select 'n_characters', count(distinct c)
from (select unnest(string_split(token, '')) as c from tokens)""")
def t23(spark, sf_dir):
    return tok.corpus_profile(views.tag_rows(spark, sf_dir),
                              views.table(spark, sf_dir, "embeddings"))


@query("t23_character_list", """
select distinct unnest(string_split(text, '')) as character from documents""")
def t23_characters(spark, sf_dir):
    return tok.character_set(views.wide_table(spark, sf_dir, "documents", "text"))


@query("t23_tag_list", sql.labelled() + "select distinct tag from tokens")
def t23_tags(spark, sf_dir):
    return tok.tag_set(views.tag_rows(spark, sf_dir))


# --- P: splits, samples, limits, row numbers --------------------------------------------

def _split(key, share, seed=0):
    return f"case when {sql.draw(key, 'split', seed=seed)} < {share} then 'train' else 'test' end"


@query("p1_random_partition", f"select o_orderkey, {_split('o_orderkey', 0.8)} as split from orders")
def p1(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey")
    return smp.with_split(o, "o_orderkey")


@query("p2_seeded_split", f"""
select o_orderkey, {_split('o_orderkey', 0.8, fixed.SPLIT_SEED)} as split from orders""")
def p2(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey")
    return smp.with_split(o, "o_orderkey", seed=fixed.SPLIT_SEED)


_LINE_KEY = "concat(l_orderkey, '-', l_linenumber)"


@query("p3_bernoulli_sample", f"""
select l_orderkey, l_linenumber, l_quantity from lineitem
where {sql.draw(_LINE_KEY, 'sample', seed=20000)} < 0.03""")
def p3(spark, sf_dir):
    li = views.table(spark, sf_dir, "lineitem")
    keyed = li.withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return smp.sample_rows(keyed, "line_key", 0.03, seed=20000).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("p4_shuffle_and_mask", f"""
select o_orderkey, cast(row_number() over (
         order by {sql.draw('o_orderkey', 'row_order', seed=42)}, o_orderkey) - 1 as bigint)
         as position, {_split('o_orderkey', 0.99, 42)} as split from orders""")
def p4(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey")
    shuffled = smp.shuffle_rows(o, "o_orderkey", seed=fixed.MESSAGE_SEED)
    return smp.with_split(shuffled, "o_orderkey", fixed.MESSAGE_TRAIN_SHARE, fixed.MESSAGE_SEED)


@query("p5_limit", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 1000")
def p5(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return smp.take_first(o, "o_orderkey", 1000)


@query("p6_row_index", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       cast(row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey,
                               l_extendedprice) - 1 as bigint) as row_index from lineitem""")
def p6(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    li = views.table(spark, sf_dir, "lineitem").select(*columns)
    return smp.with_row_index(li, columns)


@query("p7_row_count", "select count(*) as n from lineitem")
def p7(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("p8_validation_hold_out", f"""
select split, count(*) as n from (
  select case when {sql.draw('o_orderkey', 'split')} >= 0.8 then 'test'
              when {sql.draw('o_orderkey', 'validation')} < 0.2 then 'validation'
              else 'train' end as split from orders) group by split""")
def p8(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders").select("o_orderkey")
    return smp.with_validation(o, "o_orderkey").groupBy("split").agg(
        F.count(F.lit(1)).alias("n"))


# --- E: evaluation ------------------------------------------------------------------------

def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("e1_token_accuracy", sql.labelled(sql.PREDICTED, _PADDED) + """
select count(*) as total, count(*) filter (target = prediction) as correct,
       round(100.0::double * count(*) filter (target = prediction) / count(*), 6) as accuracy
from padded""")
def e1(spark, sf_dir):
    rows = ev.side_by_side(_arrays(spark, sf_dir), "key")
    return _rounded(ev.token_accuracy(rows), "accuracy")


_SCORES = """sides as (
  select target as class, 1 as s, 0 as p, (target = prediction)::int as h from predicted
  union all select prediction, 0, 1, 0 from predicted),
sums as (select class, sum(s) as support, sum(p) as predicted, sum(h) as hits
         from sides group by class),
rates as (
  select class, support, coalesce(hits / nullif(predicted, 0), 0)::double as p,
         coalesce(hits / nullif(support, 0), 0)::double as r from sums),
scores as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0)::double as f from rates)"""


@query("e2_class_scores", sql.labelled(sql.PREDICTED, _SCORES) + """
select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1,
       cast(support as bigint) as support from scores""")
def e2(spark, sf_dir):
    scores = ev.class_scores(views.predicted_rows(spark, sf_dir))
    return _rounded(scores, "precision", "recall", "f1")


@query("e2_classification_report", sql.labelled(sql.PREDICTED, _SCORES, """overall as (
  select avg((target = prediction)::int)::double as a, count(*) as support from predicted)""") + """
select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1,
       cast(support as bigint) as support from scores
union all select 'accuracy', round(a, 6), round(a, 6), round(a, 6), support from overall
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
                 cast(sum(support) as bigint) from scores
union all select 'weighted avg', round(sum(p * support) / sum(support), 6),
                 round(sum(r * support) / sum(support), 6),
                 round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint)
from scores""")
def e2_report(spark, sf_dir):
    report = ev.classification_report(views.predicted_rows(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1")


_MICRO = """sums as (
  select count(*) filter (target = prediction and target <> 'O') as hits,
         count(*) filter (prediction <> 'O') as predicted,
         count(*) filter (target <> 'O') as relevant
  from scored),
rates as (select *, coalesce(hits / nullif(predicted, 0), 0)::double as p,
                 coalesce(hits / nullif(relevant, 0), 0)::double as r from sums)
select hits, predicted, relevant, round(p, 6) as precision, round(r, 6) as recall,
       round(coalesce(2 * p * r / nullif(p + r, 0), 0)::double, 6) as f1 from rates"""


@query("e3_micro_scores", sql.labelled(
    sql.PREDICTED, "scored as (select * from predicted where target not in ('B-unit'))") +
       "," + _MICRO)
def e3(spark, sf_dir):
    rows = views.predicted_rows(spark, sf_dir)
    return _rounded(ev.micro_scores(rows, dummies=("B-unit",)), "precision", "recall", "f1")


@query("e3_micro_scores_of_pieces", sql.labelled(sql.PREDICTED, """scored as (
  select target, case when length(token) > 3 then 'O' else target end as prediction
  from predicted)""") + "," + _MICRO)
def e3_pieces(spark, sf_dir):
    pieces = tok.encode_pieces(views.tag_rows(spark, sf_dir), "key", "pos", width=4)
    wrong = F.when(F.length("piece") > 3, "O").otherwise(F.col("tag"))
    rows = pieces.select(F.col("tag").alias("target"), wrong.alias("prediction"), "is_word_start")
    return _rounded(ev.micro_scores(rows, word_start="is_word_start"),
                    "precision", "recall", "f1")


@query("e4_side_by_side", sql.labelled(sql.PREDICTED) + """
select key, cast(pos as bigint) as pos, token, target as ground_truth, prediction
from predicted""")
def e4(spark, sf_dir):
    rows = views.predicted_rows(spark, sf_dir)
    return rows.withColumnRenamed("target", "ground_truth")


# --- W: spans and wide records ---------------------------------------------------------------

_ISLANDS = """marked as (
  select p.key, p.pos, p.token, p.prediction as tag, o."begin",
         o."begin" + length(p.token) - 1 as "end",
         sum((p.prediction like 'B-%')::int) over (partition by p.key order by p.pos) as island
  from predicted p join offsets o on p.key = o.key and p.pos = o.pos),
chunks as (
  select key, island - 1 as chunk_no, arg_min(substr(tag, 3), pos) as label,
         string_agg(token, ' ' order by pos) as chunk, min("begin") as "begin", max("end") as "end"
  from marked where island > 0 and (tag like 'B-%' or tag like 'I-%') group by key, island)"""

_STRICT = """before as (
  select p.key, p.pos, p.token, p.prediction as tag, o."begin",
         o."begin" + length(p.token) - 1 as "end",
         lag(p.prediction) over (partition by p.key order by p.pos) as previous
  from predicted p join offsets o on p.key = o.key and p.pos = o.pos),
marked as (
  select *, sum((tag like 'B-%' or (tag like 'I-%' and (previous is null or previous = 'O'
                 or substr(previous, 3) <> substr(tag, 3))))::int)
            over (partition by key order by pos) as island from before),
chunks as (
  select key, island - 1 as chunk_no, arg_min(substr(tag, 3), pos) as label,
         string_agg(token, ' ' order by pos) as chunk, min("begin") as "begin", max("end") as "end"
  from marked where island > 0 and tag <> 'O' group by key, island)"""

_CHUNK_ROWS = """select key, cast(chunk_no as bigint) as chunk_no, label, chunk,
       cast("begin" as bigint) as "begin", cast("end" as bigint) as "end" from chunks"""


def _chunked(spark, sf_dir, mode="glue"):
    return wide.with_chunks(views.predicted_tokens(spark, sf_dir), mode=mode)


@query("w1_bio_chunks", sql.labelled(sql.PREDICTED, sql.OFFSETS, _ISLANDS) +
       "select key, cast(chunk_no as bigint) as chunk_no, label, chunk from chunks")
def w1(spark, sf_dir):
    rows = wide.chunk_rows(_chunked(spark, sf_dir), "key")
    return rows.select("key", "chunk_no", "label", "chunk")


@query("w1_strict_chunks", sql.labelled(sql.PREDICTED, sql.OFFSETS, _STRICT) + _CHUNK_ROWS)
def w1_strict(spark, sf_dir):
    return wide.chunk_rows(_chunked(spark, sf_dir, "strict"), "key")


@query("w2_tagged_spans", sql.labelled(sql.PREDICTED, sql.OFFSETS, _ISLANDS) + _CHUNK_ROWS)
def w2(spark, sf_dir):
    return wide.chunk_rows(_chunked(spark, sf_dir), "key")


_WIDE = ", ".join(
    f"arg_max(chunk, chunk_no) filter (label = '{label}') as {label}" for label in fixed.LABELS)


@query("w3_wide_record", sql.labelled(sql.PREDICTED, sql.OFFSETS, _ISLANDS) + f"""
, texts as (select key, string_agg(token, ' ' order by pos) as text from tokens group by key),
wide as (select key, {_WIDE} from chunks group by key)
select t.key, t.text, {', '.join('w.' + label for label in fixed.LABELS)}
from texts t left join wide w on t.key = w.key""")
def w3(spark, sf_dir):
    return wide.wide_record(_chunked(spark, sf_dir), "key")


@query("w4_nested_projection", sql.labelled() + """
select key, string_agg(token, '|' order by pos) as tokens, string_agg(tag, '|' order by pos) as tags
from tokens group by key""")
def w4(spark, sf_dir):
    base = views.plain_labelled(spark, sf_dir)
    return base.selectExpr("key", "array_join(tokens.token, '|') as tokens",
                           "array_join(tokens.tag, '|') as tags")
