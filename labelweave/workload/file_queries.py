"""Sources, sinks and the stream (S, K, ST). Each query writes the given tables
to files in the shared folder, reads them back and is compared with the tables."""

from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.config import PRESETS
from labelweave.functions.binding import unfold
from labelweave.functions import labels as lx
from labelweave.operators import labelling as lab
from labelweave.operators import records as rec
from labelweave.operators import wide
from labelweave.operators.sampling import with_row_index, with_split
from labelweave.plans import prepare
from labelweave.session import fresh_dir
from labelweave.sources import address_files as af
from labelweave.sources import corpora
from labelweave.sources import described
from labelweave.sources import sinks
from labelweave.streaming import ingest
from labelweave.workload import sql, views
from labelweave.workload.registry import query


def _file_columns(spark, sf_dir):
    """The addresses under the positional header; the id column holds the key."""
    a = views.addresses(spark, sf_dir)
    blank = F.lit(None).cast("string")
    return a.select(
        F.concat("house_number", F.lit(".25")).alias("LON"), F.lit("47.5").alias("LAT"),
        F.col("house_number").alias("NUMBER"),
        F.concat("road", F.lit(', "St."')).alias("STREET"), F.col("unit").alias("UNIT"),
        blank.alias("CITY"), blank.alias("DISTRICT"),
        F.when(F.col("key") % 5 == 0, F.lit("own")).alias("REGION"),
        F.col("postcode").alias("POSTCODE"), F.col("house_number").alias("ID"), blank.alias("HASH"),
        F.coalesce("state", F.lit("none")).alias("folder1"), F.col("city").alias("folder2"))


def _write_tree(spark, sf_dir):
    root = fresh_dir(spark, "tree")
    (_file_columns(spark, sf_dir).write.partitionBy("folder1", "folder2")
     .option("header", "true").option("escape", '"').csv(f"{root}/sub"))
    return root


_TREE = """tree as (
  select key, concat(house_number, '.25') as lon, '47.5' as lat, house_number,
         concat(road, ', "St."') as road, unit, case when key % 5 = 0 then 'own' end as own_state,
         postcode, house_number as id, coalesce(state, 'none') as folder1, city as folder2
  from addr)"""


# --- S: sources -----------------------------------------------------------------------------

@query("s1_csv_tree_scan", f"""with {sql.ADDR}, {_TREE}
select lon, lat, house_number, road, unit, own_state as state, postcode, id from tree""")
def s1(spark, sf_dir):
    rows = af.read_tree(spark, _write_tree(spark, sf_dir))
    return rows.select("lon", "lat", "house_number", "road", "unit", "state", "postcode", "id")


@query("s1_raw_line_scan", f"""with {sql.ADDR}, {_TREE}
select id, lon, road, unit from tree""")
def s1_raw(spark, sf_dir):
    lines = af.read_raw_lines(spark, _write_tree(spark, sf_dir))
    return rec.positional_records(lines).select("id", "lon", "road", "unit")


@query("s2_attach_path", f"""with {sql.ADDR}, {_TREE}
select id, 'sub' as top, folder1, replace(folder2, '_', ' ') as folder2,
       cast(4 as bigint) as n_parts from tree""")
def s2(spark, sf_dir):
    root = _write_tree(spark, sf_dir)
    rows = af.with_parts(af.read_tree(spark, root), root)
    return rows.select("id", F.get("parts", F.lit(0)).alias("top"),
                       F.get("parts", F.lit(1)).alias("folder1"),
                       F.get("parts", F.lit(2)).alias("folder2"),
                       F.size("parts").cast("bigint").alias("n_parts"))


@query("s2_records_from_tree", f"""with {sql.ADDR}, {_TREE}
select id, lon, replace(road, '.', '') as road, folder1 as country,
       coalesce(own_state, replace(folder2, '_', ' ')) as state, cast(null as varchar) as city
from tree""")
def s2_records(spark, sf_dir):
    root = _write_tree(spark, sf_dir)
    rows = rec.clean_columns(af.with_parts(af.read_tree(spark, root), root))
    return rec.with_path_fields(rows, F.col("parts")).select(
        "id", "lon", "road", "country", "state", "city")


def _mixed_headers(spark, sf_dir):
    """Two folders with other header names, order and column sets, tab separated."""
    root = fresh_dir(spark, "mixed")
    a = views.addresses(spark, sf_dir)
    even = a.filter("key % 2 = 0").select(
        F.col("road").alias("Street"), F.col("house_number").alias("House Number"),
        F.col("city").alias("City"), F.lit("CAN").alias("Country"),
        F.col("postcode").alias("Postcode"))
    odd = a.filter("key % 2 = 1").select(
        F.col("state").alias("State"), F.col("city").alias("City"),
        F.col("house_number").alias("HouseNumber"), F.col("road").alias("Street"),
        F.col("postcode").alias("Postcode"), F.col("unit").alias("HASH"))
    for frame, name in ((even, "one"), (odd, "two")):
        frame.write.options(header="true", sep="\t").csv(f"{root}/{name}")
    return root


@query("s3_header_driven_read", f"""with {sql.ADDR}
select house_number, road, city, case when key % 2 = 0 then 'CAN' end as country,
       case when key % 2 = 1 then state end as state, postcode from addr""")
def s3(spark, sf_dir):
    merged = af.read_by_header(spark, [_mixed_headers(spark, sf_dir)], sep="\t", keep_path=False)
    return merged.select("house_number", "road", "city", "country", "state", "postcode")


@query("s1_records_over_lines", f"""with {sql.ADDR}, {_TREE}
select lon, house_number, concat(substr(road, 1, length(road) - 6), chr(10), '"St."') as road, unit, id from tree""")
def s1_over_lines(spark, sf_dir):
    root = fresh_dir(spark, "tree-lines")
    over = F.concat(F.rtrim(F.replace("STREET", F.lit(' "St."'), F.lit(""))), F.lit('\n"St."'))
    (_file_columns(spark, sf_dir).withColumn("STREET", over).write.partitionBy("folder1")
     .option("header", "true").option("escape", '"').csv(root))
    return af.read_tree_records(spark, root).select("lon", "house_number", "road", "unit", "id")


def _odd_layouts(spark, sf_dir):
    """Files with quoted, doubled and unknown names, separators in names, and
    values over several lines; every third address in a layout of its own."""
    root = fresh_dir(spark, "layouts")
    a = views.addresses(spark, sf_dir)
    road = F.concat("road", F.lit(',\n"'), "unit", F.lit('"'))
    layouts = (
        [F.coalesce("road", F.lit("")).alias("Street, old"), F.col("house_number").alias("Number"), road.alias("STREET"),
         F.col("city").alias("City")],
        [F.col("postcode").alias("Post Code"), F.lit("").alias("NUMBER"), F.col("city").alias("CITY"),
         F.col("house_number").alias("House_Number"), road.alias("road")],
        [F.col("state").alias("Region"), F.col("city").alias("no,name"), F.col("house_number").alias("house number")])
    for rest, columns in enumerate(layouts):
        a.filter(F.col("key") % 3 == rest).select(*columns).write.options(
            header="true", quoteAll=str(rest != 1).lower(), escape='"').csv(f"{root}/{rest}")
    return root


@query("s3_layouts_in_one_scan", f"""with {sql.ADDR}
select house_number, case when key % 3 < 2 then road || ',' || chr(10) || '"' || unit || '"' end as road,
       case when key % 3 < 2 then city end as city, case when key % 3 = 1 then postcode end as postcode,
       case when key % 3 = 2 then state end as state from addr""")
def s3_layouts(spark, sf_dir):
    merged = af.read_by_header(spark, [_odd_layouts(spark, sf_dir)], keep_path=False)
    return merged.select("house_number", "road", "city", "postcode", "state")


@query("s4_inferred_csv_read", """
select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders""")
def s4(spark, sf_dir):
    path = fresh_dir(spark, "orders-csv")
    o = views.table(spark, sf_dir, "orders")
    o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").write.option(
        "header", "true").csv(path)
    read = af.read_csv(spark, path)
    return read.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                       F.col("o_custkey").cast("bigint").alias("o_custkey"),
                       F.col("o_totalprice").cast("double").alias("o_totalprice"),
                       "o_orderpriority")


@query("s5_union_of_listed_files", f"""with {sql.ADDR}
select house_number, road, unit, city, state, postcode from addr
union all select s_name, null, null, n_name, null, null
from supplier join nation on s_nationkey = n_nationkey""")
def s5(spark, sf_dir):
    root = fresh_dir(spark, "listed")
    a = views.addresses(spark, sf_dir).drop("key")
    s = views.table(spark, sf_dir, "supplier")
    n = views.table(spark, sf_dir, "nation")
    more = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("CITY"), F.col("s_name").alias("NUMBER"))
    a.write.option("header", "true").csv(f"{root}/a")
    more.write.option("header", "true").csv(f"{root}/b")
    merged = af.read_by_header(spark, [f"{root}/a", f"{root}/b"], keep_path=False)
    return merged.select(*views.ADDRESS_COLUMNS)


def _write_corpus_text(spark, sf_dir, docstart="before"):
    path = fresh_dir(spark, "conll")
    sinks.write_conll(sinks.conll_blocks(views.plain_labelled(spark, sf_dir)), path, docstart)
    return path


_DOC_TEXTS = sql.labelled() + """,
docs as (select key, string_agg(token, ' ' order by pos) as text,
                string_agg(tag, ' ' order by pos) as tags from tokens group by key)"""


@query("s6_manifest_read", _DOC_TEXTS + "select text, tags from docs union all select text, tags from docs")
def s6(spark, sf_dir):
    root = fresh_dir(spark, "manifest")
    blocks = sinks.conll_blocks(views.plain_labelled(spark, sf_dir))
    for name in ("first", "second", "unlisted"):
        sinks.write_conll(blocks, f"{root}/corpora/{name}")
    names = spark.createDataFrame([("first ",), ("second",), ("",)], "text string")
    sinks.write_lines(names, f"{root}/names")
    docs = af.read_manifest(spark, f"{root}/names", f"{root}/corpora",
                            lambda paths: corpora.read_conll(spark, paths))
    return docs.select("text", F.array_join("tokens.tag", " ").alias("tags"))


@query("s7_conll_read", _DOC_TEXTS + "select text, tags from docs")
def s7(spark, sf_dir):
    docs = corpora.read_conll(spark, _write_corpus_text(spark, sf_dir))
    return docs.select("text", F.array_join("tokens.tag", " ").alias("tags"))


@query("s8_parquet_read", """
select l_orderkey, l_quantity from lineitem where l_returnflag = 'R'""")
def s8(spark, sf_dir):
    li = corpora.read_annotated(spark, f"{sf_dir}/lineitem.parquet")
    return li.filter("l_returnflag = 'R'").select("l_orderkey", "l_quantity")


def _geocoder_json(a):
    components = F.struct("house_number", "road", "unit", "city",
                          F.col("state").alias("STATE"), "postcode", F.lit("x").alias("planet"))
    other = F.struct(*[F.lit("other").alias(c) for c in
                       ("house_number", "road", "unit", "city", "STATE", "postcode", "planet")])
    return F.to_json(F.array(F.struct(components.alias("components")),
                             F.struct(other.alias("components"))))


@query("s9_geocoder_json_lines", f"""with {sql.ADDR}, {sql.FIELDS}
select postcode, label, value from fields join (select key, postcode from addr) using (key)""")
def s9(spark, sf_dir):
    path = fresh_dir(spark, "geocoder")
    a = views.addresses(spark, sf_dir)
    a.select(_geocoder_json(a).alias("value")).write.text(path)
    pairs = described.read_geocoder_lines(spark, path, files="*.txt").select("pairs")
    post = F.expr("filter(pairs, p -> p.label = 'postcode')[0].value")
    rows = unfold(pairs.withColumn("postcode", post), ["postcode"], "pairs")
    return rows.select("postcode", "item.label", "item.value")


_LITERAL = "70 york street toronto ontario Canada l2n 8f4"


@query("s10_literal_frame", f"""
with texts as (select '{_LITERAL}' as text union all select text from benchmark
               union all select text from conversations)
select text, cast(len(string_split(text, ' ')) as bigint) as n_words from texts""")
def s10(spark, sf_dir):
    texts = described.literal_texts(spark, [_LITERAL])
    for name in ("benchmark", "conversations"):
        texts = texts.unionByName(views.table(spark, sf_dir, name).select("text"))
    return texts.select("text", F.size(F.split("text", " ")).cast("bigint").alias("n_words"))


@query("s11_filtered_entities", """
select d.doc_id, d.lang, d.n_chars from documents d join labels l on d.doc_id = l.doc_id
where l.quality = 1""")
def s11(spark, sf_dir):
    entities = views.table(spark, sf_dir, "labels").withColumn("training", F.col("quality") == 1)
    kept = corpora.fetch_entities(entities, "training", ["doc_id"])
    d = views.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return d.join(kept, "doc_id")


@query("s12_headerless_latin1_read", """
select l.toxic::varchar as sentiment, d.doc_id::varchar as id, d.source as date,
       'none' as query_string, d.lang as "user",
       trim(regexp_replace(d.text, '[^ -~À-ÿ]+', ' ', 'g')) as text
from documents d join labels l using (doc_id)""")
def s12(spark, sf_dir):
    path = fresh_dir(spark, "messages")
    d = views.table(spark, sf_dir, "documents")
    q = views.table(spark, sf_dir, "labels")
    single_line = F.trim(F.regexp_replace("text", "[^ -~À-ÿ]+", " "))
    rows = d.join(q, "doc_id").select(
        F.col("toxic").cast("string").alias("sentiment"), F.col("doc_id").alias("id"),
        F.col("source").alias("date"), F.lit("none").alias("query_string"),
        F.col("lang").alias("user"), single_line.alias("text"))
    rows.write.options(encoding="ISO-8859-1", escape='"').csv(path)
    return described.read_messages(spark, path)


@query("s13_flatten_geocoder_result", f"""with {sql.ADDR}
select key, house_number, road, city from addr""")
def s13(spark, sf_dir):
    a = views.addresses(spark, sf_dir)
    nested = F.to_json(F.struct(F.struct(F.struct("house_number", "road", "city")
                                         .alias("address")).alias("result")))
    schema = "result struct<address struct<house_number string, road string, city string>>"
    return described.flatten_json(a.select("key", nested.alias("value")), "value", schema,
                                  "result.address", ["house_number", "road", "city"])


@query("s13_flatten_event_properties", """
select event_id, cast(json_extract(props, '$.k') as integer) as k from events""")
def s13_events(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("event_id", "props")
    return described.flatten_json(e, "props", "k int", "", ["k"])


@query("s14_xml_addresses", f"with {sql.ADDR} select key, road, city, postcode from addr")
def s14(spark, sf_dir):
    path = fresh_dir(spark, "xml")
    a = views.addresses(spark, sf_dir).select("key", "road", "city", "postcode")
    a.write.format("xml").option("rowTag", "Address").option("rootTag", "List").save(path)
    return described.read_xml_addresses(spark, path, "Address", "key bigint, road string, "
                                        "city string, postcode string")


_HAN = "零一二三四五六七八九"


@query("s15_bilingual_split", f"""with {sql.ADDR},
mixed as (select key, concat(road, ' ', translate(house_number, '0123456789', '{_HAN}'), '號 ',
                             city, '街') as t from addr where road is not null)
select key, trim(regexp_replace(regexp_replace(t, '\\p{{Han}}+', ' ', 'g'), ' +', ' ', 'g'))
            as english,
       regexp_replace(t, '[^\\p{{Han}}]+', '', 'g') as chinese from mixed""")
def s15(spark, sf_dir):
    a = views.addresses(spark, sf_dir).filter("road is not null")
    mixed = F.concat("road", F.lit(" "), F.translate("house_number", "0123456789", _HAN),
                     F.lit("號 "), "city", F.lit("街"))
    return described.split_bilingual(a.select("key", mixed.alias("t")), "t").drop("t")


@query("s16_address_string_parse", f"""with {sql.ADDR}
select key, unit, road, city, postcode from addr""")
def s16(spark, sf_dir):
    a = views.addresses(spark, sf_dir)
    text = F.concat_ws(", ", *[F.coalesce(F.col(c), F.lit(""))
                               for c in ("unit", "road", "city", "postcode")])
    return described.parse_address_string(a.select("key", text.alias("t")), "t",
                                          ["unit", "road", "city", "postcode"]).drop("t")


# --- K: sinks --------------------------------------------------------------------------------

_SPLIT = f"case when {sql.draw('key', 'split')} < 0.8 then 'train' else 'test' end"


@query("k1_corpus_parquet", sql.labelled(sql.OFFSETS) + f""",
texts as (select key, string_agg(token, ' ' order by pos) as text from tokens group by key)
select t.text, {_SPLIT} as split, cast(pos as bigint) as pos, tag as result, token as word,
       "begin", "begin" + length(token) - 1 as "end", 0.0::double as embedding
from offsets o join texts t using (key)""")
def k1(spark, sf_dir):
    path = fresh_dir(spark, "corpus")
    annotated = with_split(lab.annotate(views.plain_labelled(spark, sf_dir)), "key")
    sinks.write_corpus(annotated, path)
    read = corpora.read_annotated(spark, path)
    rows = unfold(read, ["text", "split"], "label", value="a")
    return rows.select("text", "split", "pos", "a.result",
                       F.col("a.metadata.word").alias("word"),
                       F.col("a.begin").cast("bigint").alias("begin"),
                       F.col("a.end").cast("bigint").alias("end"),
                       F.get("a.embeddings", F.lit(0)).alias("embedding"))


@query("k2_overwrite_parquet", f"with {sql.ADDR} select key, road, city from addr where key % 2 = 0")
def k2(spark, sf_dir):
    path = fresh_dir(spark, "overwritten")
    a = views.addresses(spark, sf_dir).select("key", "road", "city")
    sinks.write_parquet(a, path)
    sinks.write_parquet(a.filter("key % 2 = 0"), path)
    return spark.read.parquet(path)


_FILE_LINES = sql.labelled() + """,
lines as (
  select concat(token, ' NN NN ', tag, ' ') as line, count(*) as n from tokens group by 1
  union all select '', {blank} from (select count(distinct key) as n from tokens)
  union all select '-DOCSTART- -X- -X- O', {head} from (select count(distinct key) as n from tokens))
select line, cast(n as bigint) as n from lines"""


def _line_counts(spark, path):
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("k3_conll_header_before", _FILE_LINES.format(blank="2 * n", head="n"))
def k3(spark, sf_dir):
    return _line_counts(spark, _write_corpus_text(spark, sf_dir))


@query("k3_conll_split_folders", _DOC_TEXTS + f"select text, tags, {_SPLIT} as split from docs")
def k3_split(spark, sf_dir):
    path = fresh_dir(spark, "conll-split")
    labelled = with_split(views.plain_labelled(spark, sf_dir), "key")
    sinks.write_conll(sinks.conll_blocks(labelled, keep=("split",)), path, by=("split",))
    docs = None
    for split in ("train", "test"):
        read = corpora.read_conll(spark, f"{path}/split={split}").select(
            "text", F.array_join("tokens.tag", " ").alias("tags"), F.lit(split).alias("split"))
        docs = read if docs is None else docs.unionByName(read)
    return docs


@query("k4_conll_header_behind", _DOC_TEXTS + "select text, tags from docs")
def k4(spark, sf_dir):
    docs = corpora.read_conll(spark, _write_corpus_text(spark, sf_dir, "after"))
    return docs.select("text", F.array_join("tokens.tag", " ").alias("tags"))


@query("k4_collapse_headers", sql.labelled() + f""",
docs as (select key, string_agg(token, ' ' order by pos) as text from tokens group by key)
select key, concat('{fixed.DOCSTART}', chr(10), chr(10), text, chr(10), chr(10),
                   '{fixed.DOCSTART}', chr(10), chr(10), text) as text from docs""")
def k4_collapse(spark, sf_dir):
    head = F.lit(f"{fixed.DOCSTART}\n\n")
    doubled = F.concat(head, head, head, "text", F.lit("\n\n"), head, head, "text")
    base = views.plain_labelled(spark, sf_dir)
    return base.select("key", lx.collapse_docstarts(doubled).alias("text"))


@query("k5_address_lines", sql.labelled() + """
select string_agg(token, ' ' order by pos) as value from tokens group by key""")
def k5(spark, sf_dir):
    path = fresh_dir(spark, "lines")
    sinks.write_lines(views.plain_labelled(spark, sf_dir), path)
    return spark.read.text(path)


@query("k6_predictions_csv", """
select quality::varchar as sentiment, 'text "' || doc_id || '", more' as text,
       quality::double as label, toxic::double as prediction from labels""")
def k6(spark, sf_dir):
    path = fresh_dir(spark, "predictions")
    q = views.table(spark, sf_dir, "labels")
    text = F.concat(F.lit('text "'), "doc_id", F.lit('", more'))
    rows = q.select(F.col("quality").cast("string").alias("sentiment"), text.alias("text"),
                    F.col("quality").cast("double").alias("label"),
                    F.col("toxic").cast("double").alias("prediction"))
    sinks.write_predictions(rows, path)
    schema = "sentiment string, text string, label double, prediction double"
    return af.read_csv(spark, path, schema)


@query("k7_records_csv", sql.labelled() + f""",
texts as (select key, string_agg(token, ' ' order by pos) as text from tokens group by key),
chunks as (select key, substr(tag, 3) as label, string_agg(token, ' ' order by pos) as chunk
           from tokens group by key, substr(tag, 3))
select text, max(chunk) filter (label = 'road') as road,
       max(chunk) filter (label = 'city') as city, max(chunk) filter (label = 'unit') as unit
from texts join chunks using (key) group by key, text""")
def k7(spark, sf_dir):
    path = fresh_dir(spark, "records")
    chunked = wide.with_chunks(views.plain_labelled(spark, sf_dir))
    sinks.write_records(wide.wide_record(chunked, labels=("road", "city", "unit")), path)
    return spark.read.schema("text string, road string, city string, unit string").option(
        "escape", '"').csv(path)


@query("k8_concatenated_corpora", sql.labelled() + """,
docs as (select key, string_agg(concat(token, ' NN NN ', tag), '|' order by pos) as block
         from tokens group by key),
ranked as (
  select 0 as source_rank, key, block from docs where key % 2 = 0
  union all select 1, key, block from docs where key % 2 = 1
  union all select 2, key, block from docs where key % 2 = 0)
select row_number() over (order by source_rank, key) as position, block from ranked""")
def k8(spark, sf_dir):
    root = fresh_dir(spark, "parts")
    base = views.plain_labelled(spark, sf_dir)
    for name, rest in (("even", 0), ("odd", 1)):
        # In key order over several files, so that the order of files shows.
        part = base.filter(F.col("key") % 2 == rest).repartitionByRange(3, "key").sortWithinPartitions("key")
        sinks.write_conll(sinks.conll_blocks(part), f"{root}/{name}")
    ranked = corpora.concatenate(spark, [f"{root}/even", f"{root}/odd", f"{root}/even"])
    sinks.write_concatenated(ranked.filter(F.trim("value", F.lit("\n")) != fixed.DOCSTART), f"{root}/joined")
    joined = corpora.concatenate(spark, [f"{root}/joined"])
    block = F.array_join(F.transform(F.split(F.trim("value", F.lit("\n")), "\n"), lambda line: F.trim(line)), "|")
    numbered = with_row_index(joined.withColumn("block", block).filter("block <> ''"),
                              ["source_rank", "path", "block_start", "doc_no"], name="position")
    return numbered.select((F.col("position") + 1).alias("position"), "block")


@query("k9_entity_dump_repair", sql.labelled() + f"""
select concat('{fixed.DOCSTART}', chr(10), chr(10),
              string_agg(concat(token, ' NN NN ', tag, ' '), chr(10) order by pos), chr(10))
       as block from tokens group by key""")
def k9(spark, sf_dir):
    path = fresh_dir(spark, "dump")
    base = sinks.conll_blocks(views.plain_labelled(spark, sf_dir), keep=("key",))
    lines = F.replace(F.rtrim("block", F.lit("\n")), F.lit("\n"), F.lit("\\n"))
    text = F.concat(F.lit(f"'Text': '{fixed.DOCSTART}\\n\\n"), lines, F.lit("'"))
    flag = F.lit("'Training': True")
    body = F.when(F.col("key") % 2 == 0, F.concat_ws(", ", flag, text)).otherwise(
        F.concat_ws(", ", text, flag))
    dumped = F.concat(F.lit(f"{fixed.ENTITY_MARK}('Corpus' "), "key", F.lit(") {"), body,
                      F.lit("}>"))
    base.select(dumped.alias("value")).write.text(path)
    return corpora.read_entity_dump(spark, path)


# --- flow A: a folder tree to a labelled corpus ----------------------------------------------------

_PREPARED = f"""with {sql.ADDR}, {_TREE},
present as (
  select 'house_number' as label, house_number as value from tree union all select 'road', road from tree
  union all select 'unit', unit from tree union all select 'country', folder1 from tree
  union all select 'state', coalesce(own_state, replace(folder2, '_', ' ')) from tree
  union all select 'postcode', postcode from tree),
spoken as (
  select label, list_filter(regexp_split_to_array(replace(value, '.', ''), '[ _]'), lambda x: x <> '') as w from present
  where value is not null),
said as (select label, unnest(w) as token, unnest(range(0, len(w))) as i from spoken)
select token, case when i = 0 then 'B-' else 'I-' end || label as tag, count(*) as n from said group by all"""


@query("flow_a_prepare", _PREPARED)
def flow_a(spark, sf_dir):
    """The whole preparation, files to files; orders differ by row, so that the
    tokens and tags of the corpus are compared, not their order."""
    out = fresh_dir(spark, "prepared")
    prepare.prepare_corpus(spark, _write_tree(spark, sf_dir), out, augmentation=PRESETS["none"])
    said = unfold(corpora.read_annotated(spark, out), [], "label", value="a")
    return said.groupBy(F.col("a.metadata.word").alias("token"), F.col("a.result").alias("tag")).agg(
        F.count(F.lit(1)).alias("n"))


# --- ST: the stream ------------------------------------------------------------------------------

def _uploads_folder(spark, sf_dir):
    """CSV files, geocoder lines and files to be ignored in one upload folder."""
    root = fresh_dir(spark, "uploads")
    a = views.addresses(spark, sf_dir)
    held = {label: F.col(label) for label in views.ADDRESS_COLUMNS}
    named = [held.get(label, F.lit(None).cast("string")).alias(header)
             for header, label in zip(fixed.FILE_HEADER, fixed.FILE_LABELS)]
    a.filter("key % 4 = 0").select(*named).write.option("header", "true").csv(f"{root}/csv")
    # A second layout: other columns in another order, under other names.
    other = [F.col("postcode").alias("POSTCODE"), F.col("city").alias("City"), F.col("road").alias("Road"),
             F.col("house_number").alias("House Number"), F.col("unit").alias("Unit"), F.col("state").alias("State")]
    a.filter("key % 4 = 2").select(*other).write.option("header", "true").csv(f"{root}/more")
    a.filter("key % 2 = 1").select(_geocoder_json(a).alias("value")).write.text(f"{root}/lines")
    a.select("city").write.json(f"{root}/other")
    return root


# Spark names the files it writes, so the geocoder files are told by their ending.
_JSON_FILES = "*.txt"

_TAG_COUNTS = "select token, tag, count(*) as n from tokens {where} group by token, tag"


def _tag_counts(docs):
    rows = unfold(docs, [], "tokens").select("item.token", "item.tag")
    return rows.groupBy("token", "tag").agg(
        F.count(F.lit(1)).alias("n"))


def _ingested(spark, root, **settings):
    out, state = fresh_dir(spark, "stream-out"), fresh_dir(spark, "stream-state")
    ingest.run_ingest(spark, root, out, state, **settings)
    return out


@query("st1_stream_ingest", sql.labelled() + _TAG_COUNTS.format(where="where key % 2 = 0"))
def st1(spark, sf_dir):
    out = _ingested(spark, _uploads_folder(spark, sf_dir), tag_mode="position",
                    augmentation=PRESETS["none"])
    return _tag_counts(corpora.read_conll(spark, [out]))


@query("st1_quarantine", f"""with {sql.ADDR},
good as (select count(*) as n from addr where key % 2 = 1 and key % 7 <> 0)
select 'no column of a known name' as reason, count(*) as lines, any_value(good.n) as rows_taken from addr, good where key % 4 = 2
union all select 'no geocoder result', count(*), any_value(good.n) from addr, good where key % 2 = 1 and key % 7 = 0""")
def st1_quarantine(spark, sf_dir):
    root, out = fresh_dir(spark, "uploads"), fresh_dir(spark, "stream-out")
    a = views.addresses(spark, sf_dir)
    a.filter("key % 4 = 2").select(F.col("city").alias("foo"), F.col("road").alias("bar")).write.option(
        "header", "true").csv(f"{root}/csv")
    line = F.when(F.col("key") % 7 == 0, F.concat(F.lit("no json "), "house_number")).otherwise(_geocoder_json(a))
    a.filter("key % 2 = 1").select(line.alias("value")).write.text(f"{root}/lines")
    ingest.run_ingest(spark, root, out, fresh_dir(spark, "stream-state"), sink="parquet", json_files=_JSON_FILES, max_files=5)
    taken = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows_taken"))
    found = spark.read.schema("path string, reason string, lines long, example string").json(f"{out}_quarantine")
    return found.groupBy("reason").agg(F.sum("lines").alias("lines")).join(taken)


@query("st2_route_by_name", sql.labelled() + _TAG_COUNTS.format(where=""))
def st2(spark, sf_dir):
    out = _ingested(spark, _uploads_folder(spark, sf_dir), tag_mode="position",
                    augmentation=PRESETS["none"], json_files=_JSON_FILES)
    return _tag_counts(corpora.read_conll(spark, [out]))


@query("st3_stream_equals_batch", """
select split, cast(0 as bigint) as n_stream_only, cast(0 as bigint) as n_batch_only
from (values ('train'), ('test')) t(split)""")
def st3(spark, sf_dir):
    root = _uploads_folder(spark, sf_dir)
    out = _ingested(spark, root, sink="parquet", json_files=_JSON_FILES)
    columns = ["key", "split", "text"]
    streamed = spark.read.parquet(out).select(*columns, F.lit(1).alias("s"), F.lit(0).alias("b"))
    batch = ingest.label_uploads(ingest.uploads(spark, root, _JSON_FILES)).select(
        *columns, F.lit(0).alias("s"), F.lit(1).alias("b"))
    # Equal rows are counted on both sides, in one shuffle.
    both = streamed.unionByName(batch).groupBy(*columns).agg(
        F.sum("s").alias("s"), F.sum("b").alias("b"))
    return both.groupBy("split").agg(
        F.sum(F.greatest(F.col("s") - F.col("b"), F.lit(0))).cast("bigint").alias("n_stream_only"),
        F.sum(F.greatest(F.col("b") - F.col("s"), F.lit(0))).cast("bigint").alias("n_batch_only"))
