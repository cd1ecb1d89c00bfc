"""Ordinary data that earlier versions lost, merged or mislabelled."""

import json

import numpy as np
from pyspark.sql import functions as F

from labelweave.operators import labelling as lab
from labelweave.operators import tagger as tg
from labelweave.operators import tokens as tok
from labelweave.plans import tagging
from labelweave.sources import address_files as af
from labelweave.sources import corpora, described, sinks


def test_sentences_keep_their_marks(spark):
    rows = spark.createDataFrame([("...Main Road",), ("?!",), ("70 York St. Toronto",), ("",)], "text string")
    got = [r["sentences"] for r in tok.with_sentences(rows).collect()]
    assert got == [["...Main Road"], ["?!"], ["70 York St.", "Toronto"], []]


def test_equal_texts_stay_apart_and_every_text_gives_a_record(spark):
    texts = ["70 York", "70 York", "", None, "?!", "70 York St. Toronto"]
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "id long, text string")
    names = ["B-city", "B-road"]
    even = lambda rows: rows.withColumn("probabilities", F.array(F.lit(0.4), F.lit(0.6)))
    tagged = tagging.with_tagged_tokens(tagging.tokenise_texts(df), even, names, np.zeros(2), np.zeros((2, 2)))
    got = [(r["text"], [t["token"] for t in r["tokens"]]) for r in tagged.collect()]
    assert sorted(got, key=str) == sorted([
        ("70 York", ["70", "York"]), ("70 York", ["70", "York"]), ("", []), (None, []), ("?!", ["?", "!"]),
        ("70 York St. Toronto", ["70", "York", "St", ".", "Toronto"])], key=str)
    records = tagging.records_of(tagged, "id")
    assert records.count() == 6 and {r["road"] for r in records.collect() if r["text"] == "70 York"} == {"York"}


def test_paths_of_a_batch_equal_single_paths():
    rng = np.random.default_rng(0)
    start, moves = rng.normal(size=4), rng.normal(size=(4, 4))
    rows = [list(rng.normal(size=(n, 4))) for n in (3, 1, 0, 7, 3, 3, 7)]
    single = [tg.best_path(np.stack(r), start, moves) if r else [] for r in rows]
    assert [list(p) for p in tg.best_paths(rows, start, moves)] == single


def test_hot_tokens_can_be_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 10 > 0, "the").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("token"),
            F.lit("X").alias("tag"), F.rand(1).alias("payload"))
        joined = tok.apply_lexicon(rows, tok.fit_lexicon(rows))
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 400_000
        found = joined.groupBy("pos_tag").agg(F.sum("payload"))
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_corpus_with_carriage_returns(spark, tmp_path):
    (tmp_path / "a.conll").write_bytes(
        b"-DOCSTART- -X- -X- O\r\n\r\n70 NN NN B-house_number \r\nYork NN NN B-road \r\n\r\nRome NN NN B-city \r\n")
    got = corpora.read_conll(spark, str(tmp_path)).orderBy("doc_no").collect()
    assert [r["text"] for r in got] == ["70 York", "Rome"]
    assert [t["tag"] for t in got[0]["tokens"]] == ["B-house_number", "B-road"]


def test_files_of_one_source_follow_each_other(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i} NN NN O\n\n" for i in range(50)))
    sinks.write_concatenated(corpora.concatenate(spark, [str(tmp_path / "*.txt")]), str(tmp_path / "out"))
    whole = corpora.concatenate(spark, [str(tmp_path / "out")]).orderBy("path", "block_start", "doc_no")
    names = [r["value"].split()[0] for r in whole.collect() if r["value"].strip()]
    assert names == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(50)]


def test_geocoder_spellings_and_unreadable_lines(spark, tmp_path):
    good = json.dumps([{"components": {"street": "Main", "NUMBER": "5", "REGION": "ON", "id": "x"}}])
    (tmp_path / "x_inputdict.txt").write_text(f"{good}\nnot json\n[]\n")
    read = described.read_geocoder_lines(spark, str(tmp_path)).collect()
    assert [{p["label"]: p["value"] for p in r["pairs"]} for r in read] == [
        {"house_number": "5", "road": "Main", "state": "ON"}]
    lost = described.unreadable_geocoder_lines(spark, str(tmp_path)).collect()
    assert sorted(r["value"] for r in lost) == ["[]", "not json"]


def test_raw_lines_skip_the_first_line_of_a_file_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text('lon,lat\n1,"x,y"\nlon,lat\n\n2,z\n')
    assert [r["value"] for r in af.read_raw_lines(spark, str(tmp_path)).collect()] == ['1,"x,y"', "lon,lat", "2,z"]


def test_offsets_of_long_rows_are_those_of_the_annotations(spark):
    rows = [(i, [f"w{'é日😀x'[j % 4] * (j % 5)}{i}" for j in range(i * 37 % 300)]) for i in range(700)]
    rows += [(7, ["a", "", "b"]), (None, ["x"]), (1, None), (2, [])]
    df = spark.createDataFrame(rows, "key long, words array<string>").coalesce(1)
    want = lab.annotation_rows(lab.annotate(df.selectExpr(
        "key", "transform(words, w -> struct(w as token, 'O' as tag)) as tokens")), "key").drop("tag")
    got = lab.offset_rows(df, "key")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert lab.offset_rows(df.limit(0), "key").count() == 0
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()
