"""Worked examples with known outcomes."""

import pytest
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.config import PRESETS, Augmentation
from labelweave.functions import fields as fx
from labelweave.functions import labels as lx
from labelweave.functions import spans as sx
from labelweave.functions import text as tx
from labelweave.operators import evaluate as ev
from labelweave.operators import labelling as lab
from labelweave.operators import records as rec
from labelweave.operators import tokens as tok
from labelweave.operators import wide
from labelweave.plans import prepare
from labelweave.sources import address_files as af
from labelweave.sources import corpora, described, sinks
from labelweave.streaming import ingest

HEADER = ",".join(fixed.FILE_HEADER)
LINE = "11.521,47.2313,70,York St.,,,,,M5H 1J8,,h1"


def _tree(root, files):
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    return str(root)


@pytest.fixture
def tree(tmp_path):
    return _tree(tmp_path / "in", {
        "sub/ca/on/Toronto.csv": f"{HEADER}\n{LINE}\n\n",
        "sub/ca/countrywide.csv": f"{HEADER}\n1,2,5,\"Main, Rd\",,Ottawa,,,K1A,,h2\n",
        "sub/us/ny/new_york.csv": f"{HEADER}\n1,2,9,Wall St,,,,,12345,,h3,surplus\n",
        "sub/us/state_wide.csv": f"{HEADER}\n1,2,8,Short\n",
        "sub/us/district9.csv": f"{HEADER}\n1,2,7,Long,,,,,1,,h5\n",
        "sub/us/notes.txt": "not an address\n",
    })


def _records(spark, root, strip="fields"):
    rows = rec.clean_columns(af.with_parts(af.read_tree(spark, root), root), strip_periods=strip)
    full = rec.with_path_fields(rows, F.col("parts"))
    return {r["house_number"]: r.asDict() for r in full.collect()}


def test_path_and_csv(spark, tree):
    rows = _records(spark, tree)
    assert len(rows) == 5
    york = rows["70"]
    assert (york["country"], york["state"], york["city"]) == ("ca", "on", "Toronto")
    assert (york["road"], york["postcode"], york["hash"]) == ("York St", "M5H 1J8", "h1")
    assert york["unit"] is york["state_district"] is york["id"] is None
    assert york["lon"] == "11.521"
    assert _records(spark, tree, "all")["70"]["lon"] == "11521"


def test_generic_file_names(spark, tree):
    rows = _records(spark, tree)
    assert (rows["5"]["country"], rows["5"]["state"], rows["5"]["city"]) == ("ca", None, "Ottawa")
    assert rows["5"]["road"] == "Main, Rd"
    assert (rows["9"]["state"], rows["9"]["city"]) == ("ny", "new york")
    assert rows["8"]["city"] is None and rows["8"]["postcode"] is None
    assert rows["7"]["city"] is None


def test_template_and_offsets(spark, tree):
    rows = rec.clean_columns(af.with_parts(af.read_tree(spark, tree), tree))
    full = rec.with_fields(rec.with_path_fields(rows.filter("hash = 'h1'"), F.col("parts")))
    labelled = lab.label_records(lab.with_order(full, "hash", template=0))
    assert labelled.first()["text"] == "70 York St Toronto on M5H 1J8 ca"
    found = [tuple(r) for r in lab.annotation_rows(lab.annotate(labelled)).orderBy("pos").collect()]
    assert found == [
        (0, "70", "B-house_number", 0, 1), (1, "York", "B-road", 3, 6), (2, "St", "I-road", 8, 9),
        (3, "Toronto", "B-city", 11, 17), (4, "on", "B-state", 19, 20),
        (5, "M5H", "B-postcode", 22, 24), (6, "1J8", "I-postcode", 26, 28),
        (7, "ca", "B-country", 30, 31)]


def test_preparation_plan_moves_no_row(spark, tree):
    df = prepare.label_tree(spark, tree)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    rows = df.collect()
    assert len(rows) == 5
    for row in rows:
        for a in row["label"]:
            assert row["text"][a["begin"]:a["end"] + 1] == a["metadata"]["word"]


def test_prepared_corpus_round_trip(spark, tree, tmp_path):
    prepare.prepare_corpus(spark, tree, str(tmp_path / "out"))
    read = corpora.read_annotated(spark, str(tmp_path / "out"))
    assert read.count() == 5
    assert dict(lab.cast_label(read).dtypes)["label"] == (
        "array<struct<annotatorType:string,begin:int,end:int,result:string,"
        "metadata:map<string,string>,embeddings:array<float>>>")


def test_raw_lines_leave_headers_out(spark, tree):
    assert af.read_raw_lines(spark, tree).filter("trim(value) <> ''").count() == 5


def test_parsing_trims_and_pads(spark):
    df = spark.createDataFrame([('3, "4, x", "say ""hi"""',), ("",)], "value string")
    rows = rec.positional_records(df).collect()
    assert len(rows) == 1
    assert (rows[0]["lon"], rows[0]["lat"], rows[0]["house_number"], rows[0]["road"]) == (
        "3", "4, x", 'say "hi"', None)


def test_sample_files_with_other_headers(spark, tmp_path):
    root = _tree(tmp_path / "samples", {
        "CA/countrywide.csv": "Street\tHouse Number\tCity\tCountry\tPostcode\r\n"
                              "Main St.\t5\tToronto\tCAN\tN6C4E9\r\nSouth Rd.\t21\tLondon\tCAN\t5i2",
        "US/countrywide.csv": "State\tCity\tHouseNumber\tStreet\tPostcode\r\n"
                              "NY\tNY\t5\tWall St.\t12345\r\n"})
    rows = {r["road"]: r for r in af.read_by_header(spark, [root], sep="\t").collect()}
    assert rows["Main St."]["house_number"] == "5" and rows["Main St."]["country"] == "CAN"
    assert rows["South Rd."]["postcode"] == "5i2"
    assert rows["Wall St."]["state"] == "NY" and rows["Wall St."]["country"] is None


def test_folder_parents(spark):
    df = spark.createDataFrame([
        ("ca/on/city_of_Toronto.csv", None), ("ca/countrywide.csv", None), ("ca/on.csv", "own"),
        ("ca/on/x/deep.csv", None)], "path string, state string")
    parts = fx.parts_of(fx.relative_path(F.col("path")))
    rows = rec.with_folder_parents(df, parts).collect()
    assert [(r["country"], r["state"], r["city"]) for r in rows] == [
        ("ca", "on", "Toronto"), ("ca", None, None), ("ca", "own", None), ("ca", "on", "x")]


@pytest.mark.parametrize("mode,tags", [("position", ["B-road", "B-city"]),
                                       ("by_token", ["B-city", "B-city"])])
def test_repeated_token(spark, mode, tags):
    df = spark.createDataFrame([(1, "York", "York")], "key int, road string, city string")
    labelled = lab.label_records(lab.with_order(rec.with_fields(df), "key", template=0),
                                 tag_mode=mode)
    assert labelled.select("tokens.tag").first()["tag"] == tags


def test_raw_text_keeps_doubled_blanks(spark):
    df = spark.createDataFrame([(1, "a  b_c")], "key int, road string")
    base = lab.with_order(rec.with_fields(df), "key", template=0)
    assert lab.label_records(base, text_mode="raw").first()["text"] == "a  b_c"
    assert lab.label_records(base).first()["text"] == "a b c"


def test_record_without_fields(spark):
    df = spark.createDataFrame([(1, None)], "key int, road string")
    labelled = lab.annotate(lab.label_records(
        lab.with_order(rec.with_fields(df), "key", PRESETS["full"])))
    row = wide.with_chunks(labelled).first()
    assert (row["text"], row["tokens"], row["label"], row["chunks"]) == ("", [], [], [])


def test_message_cleaning(spark):
    text = "@bob can't wait!! http://t.co/x www.y.z It's 2GOOD"
    df = spark.createDataFrame([(text,)], "text string").select(
        tx.clean_message(F.col("text")).alias("t"))
    row = df.select("t", tx.message_words(F.col("t")).alias("w")).first()
    assert row["t"] == "can not wait   its good"
    assert row["w"] == ["can", "not", "wait", "", "", "its", "good"]


def test_ngrams_of_short_rows(spark):
    df = spark.createDataFrame([(["a", "b"],)], "w array<string>")
    row = df.select(*[tx.ngrams("w", n).alias(f"n{n}") for n in (1, 2, 3)]).first()
    assert (row["n1"], row["n2"], row["n3"]) == (["a", "b"], ["a b"], [])


def _tagged(spark, pairs):
    return spark.createDataFrame([(pairs,)], "tokens array<struct<token:string,tag:string>>")


def test_chunks(spark):
    df = _tagged(spark, [("70", "B-house_number"), ("York", "B-road"), ("St", "I-road"),
                         ("x", "O"), ("ca", "B-country")])
    found = wide.with_chunks(df).first()["chunks"]
    assert [(c["label"], c["chunk"]) for c in found] == [
        ("house_number", "70"), ("road", "York St"), ("country", "ca")]
    assert [(c["begin"], c["end"]) for c in found] == [(0, 1), (3, 9), (13, 14)]


@pytest.mark.parametrize("mode,chunks", [("glue", ["a c"]), ("strict", ["a", "c"])])
def test_chunk_modes(spark, mode, chunks):
    df = _tagged(spark, [("a", "B-road"), ("b", "O"), ("c", "I-road")])
    found = wide.with_chunks(df, mode=mode).first()["chunks"]
    assert [c["chunk"] for c in found] == chunks


def test_leading_continuation(spark):
    df = _tagged(spark, [("a", "I-road"), ("b", "B-city")])
    assert [c["chunk"] for c in wide.with_chunks(df).first()["chunks"]] == ["b"]
    strict = wide.with_chunks(df, mode="strict").first()["chunks"]
    assert [(c["label"], c["chunk"]) for c in strict] == [("road", "a"), ("city", "b")]


def test_last_chunk_wins(spark):
    df = _tagged(spark, [("x", "B-road"), ("y", "B-road")]).withColumn("text", F.lit("x y"))
    row = wide.wide_record(wide.with_chunks(df)).first()
    assert row["road"] == "y" and row["city"] is None


def test_accuracy_counts_padding(spark):
    df = spark.createDataFrame([(["t"], ["B"], ["B", "C", "D"])],
                               "tokens array<string>, targets array<string>, "
                               "predictions array<string>")
    row = ev.token_accuracy(ev.side_by_side(df)).first()
    assert (row["total"], row["correct"]) == (3, 1)
    assert round(row["accuracy"], 2) == 33.33


def test_micro_scores_of_nothing(spark):
    df = spark.createDataFrame([("B-road", "O"), ("O", "O")], "target string, prediction string")
    row = ev.micro_scores(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_length_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (5, 6, 10, 20, 50, 51)], "n int")
    found = [r[0] for r in df.select(tok.length_bucket(F.col("n"))).collect()]
    assert found == [0, 1, 1, 2, 3, 4]


def test_conll_files(spark, tmp_path):
    df = _tagged(spark, [("70", "B-house_number"), ("York", "B-road")]).coalesce(1)
    block = "70 NN NN B-house_number \nYork NN NN B-road \n"
    head = f"{fixed.DOCSTART}\n\n"
    two = sinks.conll_blocks(df.unionByName(df).coalesce(1))
    for mode, expected in (("before", (head + block + "\n") * 2),
                           ("after", head + (block + "\n" + head) * 2)):
        path = tmp_path / mode
        sinks.write_conll(two, str(path), mode)
        [file] = path.glob("part-*")
        assert file.read_text() == expected
        docs = corpora.read_conll(spark, str(path)).collect()
        assert [d["text"] for d in docs] == ["70 York"] * 2


def test_concatenation_keeps_file_order(spark, tmp_path):
    for name, token in (("b", "2"), ("a", "1")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "c.txt").write_text(
            f"{fixed.DOCSTART}\n\n{token} X X O \n\n{token}{token} X X O \n\n")
    ranked = corpora.concatenate(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
    sinks.write_concatenated(ranked, str(tmp_path / "out"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "out").glob("part-*")))
    lines = [line.split()[0] for line in text.splitlines() if line.strip()]
    assert lines == ["-DOCSTART-", "2", "22", "-DOCSTART-", "1", "11"]


def test_entity_dump(spark, tmp_path):
    (tmp_path / "d.txt").write_text(
        "<Entity('C', 1) {'Text': '-DOCSTART- -X- -X- O\\n\\n70 CD CD B-x \\nY NN NN B-y ', "
        "'Training': True}>\n<Entity('C', 2) {'T': 1, 'Text': '-DOCSTART- -X- -X- O\\n\\nQ N N B-z '}>\n")
    blocks = sorted(r["block"] for r in corpora.read_entity_dump(spark, str(tmp_path)).collect())
    assert blocks == ["-DOCSTART- -X- -X- O\n\n70 CD CD B-x \nY NN NN B-y \n",
                      "-DOCSTART- -X- -X- O\n\nQ N N B-z \n"]


def test_geocoder_line(spark):
    line = '[{"components": {"road": "Main", "CITY": "X", "planet": "earth"}}, {"components": {}}]'
    df = spark.createDataFrame([(line,)], "value string")
    pairs = df.select(described.geocoder_pairs(F.col("value")).alias("p")).first()["p"]
    assert [(p["label"], p["value"]) for p in pairs] == [("road", "Main"), ("city", "X")]


def test_bilingual_and_free_text(spark):
    df = spark.createDataFrame([("Peak Road 山頂道 12",)], "t string")
    row = described.split_bilingual(df, "t").first()
    assert (row["english"], row["chinese"]) == ("Peak Road 12", "山頂道")
    df = spark.createDataFrame([("Flat 1, , Kowloon",)], "t string")
    row = described.parse_address_string(df, "t", ["unit", "road", "city"]).first()
    assert (row["unit"], row["road"], row["city"]) == ("Flat 1", None, "Kowloon")


def test_uploads_are_routed_by_name_and_taken_once(spark, tmp_path):
    root = _tree(tmp_path / "up", {
        "a.csv": f"{HEADER}\n{LINE}\n",
        "first inputdict.txt": '[{"components": {"road": "Main", "city": "Rome"}}]\n',
        "other.txt": "ignored\n"})
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def texts():
        return sorted(r["text"] for r in spark.read.parquet(out).select("text").collect())

    plain = {"sink": "parquet", "augmentation": Augmentation()}
    ingest.run_ingest(spark, root, out, state, **plain)
    assert texts() == ["70 York St. M5H 1J8", "Main Rome"]
    _tree(tmp_path / "up", {"b.csv": f"{HEADER}\n1,2,9,Wall,,,,,1,,x\n"})
    ingest.run_ingest(spark, root, out, state, **plain)
    assert texts() == ["70 York St. M5H 1J8", "9 Wall 1", "Main Rome"]


def test_sliced_offsets_equal_plain_sums(spark):
    rows = [(["ab"] * n,) for n in (0, 1, 63, 64, 65, 128, 1000)]
    df = spark.createDataFrame(rows, "t array<string>")
    for row in df.select(F.size("t").alias("n"), lx.running_starts("t").alias("s")).collect():
        assert row["s"] == [3 * i for i in range(row["n"])]


def test_chunks_of_last_label(spark):
    df = spark.createDataFrame([(1,)], "x int").select(
        F.expr("array(named_struct('label','a','chunk','1'))").alias("c"))
    assert df.select(sx.last_chunk_of("c", "b")).first()[0] is None
