"""Tagging where the tokens lie: equal to Spark's own scoring, without a shuffle,
on a stream as on a table; and the choice of settings by a hold-out."""

import numpy as np
import pytest
from pyspark.ml.feature import FeatureHasher
from pyspark.sql import functions as F

from labelweave.functions.binding import unfold
from labelweave.operators import sampling as smp
from labelweave.operators import tagger as tg
from labelweave.plans import tagging
from labelweave.workload import views


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    labelled = smp.with_split(views.plain_labelled(spark, sf_dir), "key")
    return tagging.train(labelled.filter("split = 'train'"), max_iter=10), labelled.filter("split = 'test'")


def test_buckets_are_those_of_the_hasher(spark):
    words = ["", "a", "ab", "abc", "abcd", "abcde", "Straße", "日本語", "x" * 63, "\U0001F600é", "<start>", "70"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    hashed = FeatureHasher(inputCols=["word"], outputCol="f", numFeatures=1 << 14, categoricalCols=["word"]).transform(df)
    want = {r["word"]: int(r["f"].indices[0]) for r in hashed.collect()}
    assert dict(zip(words, tg.feature_buckets([f"word={w}" for w in words], 1 << 14).tolist())) == want


def test_scores_in_place_equal_the_regression_and_the_decoding(spark, fitted):
    tagger, held = fitted
    rows = tg.scored_rows(tagger.model, tg.context_rows(held, "key")).collect()
    by_key = {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        by_key.setdefault(r["key"], []).append(r["probabilities"])
    got = tagging.tag_texts(tagger, held.select("key", "tokens")).collect()
    assert len(got) == len(by_key)
    for r in got:
        p = np.array(by_key[r["key"]])
        path = tg.best_path(np.log(np.maximum(p, 1e-12)), tagger.start, tagger.moves)
        assert [t["tag"] for t in r["tokens"]] == [tagger.names[i] for i in path]
        assert [t["confidence"] for t in r["tokens"]] == pytest.approx([p[i, t] for i, t in enumerate(path)], abs=1e-9)


def test_nothing_moves_and_odd_rows_stay(spark, fitted):
    tagger, held = fitted
    plan = tagging.tag_texts(tagger, held.select("key", "tokens"), truth="tag")
    text = plan._jdf.queryExecution().executedPlan().toString()
    source = held.select("key", "tokens")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and text.count("Exchange") == source.count("Exchange")
    texts = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "70 York St.", "x"), (3, "70 York St.", "x"), (4, "?!", "x")],
                                  "id int, text string, confidence string")
    tagged = tagging.tag_texts(tagger, tagging.tokenise_texts(texts)).collect()
    assert sorted((r["id"], len(r["tokens"]), r["confidence"]) for r in tagged) == [
        (1, 0, "x"), (2, 0, "x"), (3, 4, "x"), (3, 4, "x"), (4, 2, "x")]
    null = spark.createDataFrame([(1, None)], "id int, tokens array<struct<token:string,tag:string>>")
    assert tagging.tag_texts(tagger, null, truth="tag").first()["tokens"] == []
    assert tagging.tag_texts(tagger, null.limit(0)).count() == 0


def test_a_stream_is_tagged_like_a_table(spark, fitted, tmp_path):
    tagger, held = fitted
    folder = str(tmp_path / "texts")
    held.select("key", "text").repartition(3).write.parquet(folder)
    table = spark.read.parquet(folder)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    tag = lambda df: tagging.records_of(tagging.tag_texts(tagger, tagging.tokenise_texts(df)), "key")
    query = (tag(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start())
    query.awaitTermination()
    out, batch = spark.read.parquet(str(tmp_path / "out")), tag(table)
    assert out.count() == table.count() and out.exceptAll(batch).count() == batch.exceptAll(out).count() == 0


def test_the_setting_that_scores_best_is_taken(spark, fitted):
    _, held = fitted
    grid = ({"max_iter": 1, "reg": 10.0}, {"max_iter": 10, "reg": 1e-4}, {"max_iter": 10, "reg": 1e-4, "buckets": 2})
    tagger, chosen, scores = tagging.train_selected(held.select("key", "tokens"), grid=grid)
    assert [s["tokens"] for s in scores] == [scores[0]["tokens"]] * 3 and scores[0]["tokens"] > 0
    assert chosen == grid[max(range(3), key=lambda i: (scores[i]["right"], -i))] == grid[1]
    assert scores[1]["accuracy"] > scores[0]["accuracy"] and tg.Weights(tagger.model).table.shape[0] == 1 << 14
    one = held.select("key", "tokens").limit(1)
    assert tagging.train_selected(one, grid=grid[:2])[1:] == (grid[0], [])
    rows = unfold(tagging.tag_texts(tagger, held.select("key", "tokens")), ["key"], "tokens")
    assert rows.agg(F.min("item.confidence")).first()[0] > 0
