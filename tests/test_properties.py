"""Properties that hold whatever the draws are."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.config import Augmentation
from labelweave.functions import draws
from labelweave.operators import evaluate as ev
from labelweave.operators import labelling as lab
from labelweave.operators import sampling as smp
from labelweave.operators import tagger as tg
from labelweave.operators import textclass as tc
from labelweave.operators import wide
from labelweave.plans import sentiment, tagging
from labelweave.sources import sinks
from labelweave.workload import views


@pytest.fixture(scope="module")
def addresses(spark, sf_dir):
    return views.labelled(spark, sf_dir, Augmentation(0.2, 0.2, 0.2)).cache()


def test_duplicate_sizes_follow_the_geometric_law(spark):
    n = 20000
    keys = spark.range(n).withColumnRenamed("id", "key")
    sizes = lab.with_order(keys, "key", Augmentation(duplicate=0.2)).groupBy(
        F.size("order").alias("size")).count().collect()
    share = {r["size"]: r["count"] / n for r in sizes}
    for extra in range(4):
        expected = 0.8 * 0.2 ** extra
        assert abs(share[12 + extra] - expected) < 4 * (expected * (1 - expected) / n) ** 0.5


def test_orders_stay_within_their_limits(spark):
    keys = spark.range(3000).withColumnRenamed("id", "key")
    full = lab.with_order(keys, "key", Augmentation(duplicate=0.97))
    cut = lab.with_order(keys, "key", Augmentation(delete=0.99))
    row = full.agg(F.min(F.size("order")), F.max(F.size("order"))).first()
    assert row[0] >= 12 and row[1] == 20
    assert cut.agg(F.min(F.size("order"))).first()[0] == 1


def test_shuffle_permutes_a_fifth_of_the_orders(spark):
    n = 10000
    keys = spark.range(n).withColumnRenamed("id", "key")
    both = lab.with_order(keys, "key", Augmentation(shuffle=0.2), template=0)
    row = both.agg(
        F.avg((F.col("order") != F.array(*[F.lit(x) for x in lab.ox.fixed.LABELS])).cast("int")),
        F.count_distinct(F.array_sort("order"))).first()
    assert abs(row[0] - 0.2) < 0.02 and row[1] == 1


def test_split_share(spark):
    n = 20000
    keys = spark.range(n).withColumnRenamed("id", "key")
    train = smp.with_split(keys, "key").filter("split = 'train'").count()
    assert abs(train / n - 0.8) < 3 * (0.16 / n) ** 0.5


def test_draws_do_not_depend_on_partitions(spark):
    keys = spark.range(500).withColumnRenamed("id", "key")
    settings = Augmentation(0.5, 0.5, 0.5)
    one, eight = (sorted(map(tuple, lab.with_order(keys.repartition(n), "key", settings)
                             .select("key", F.array_join("order", ",")).collect()))
                  for n in (1, 8))
    assert one == eight


def test_draws_of_steps_and_seeds_differ(spark):
    row = spark.range(1).select(draws.uniform("id", "a"), draws.uniform("id", "a", "1"),
                                draws.uniform("id", "a", seed=1), draws.uniform("id", "b")).first()
    assert len(set(row)) == 4 and all(0 <= u < 1 for u in row)


def test_labels_fit_their_text(addresses):
    annotated = lab.annotate(addresses)
    rows = lab.annotation_rows(annotated, "key", "text")
    wrong = rows.filter("substring(text, cast(begin + 1 as int), cast(end - begin + 1 as int)) "
                        "<> token")
    assert wrong.count() == 0 and rows.count() > 500
    assert annotated.filter("size(label) <> size(tokens)").count() == 0


def test_continuing_tags_follow_their_label(addresses):
    for row in addresses.select("tokens.tag").collect():
        for before, tag in zip([None, *row["tag"]], row["tag"]):
            if tag.startswith("I-"):
                assert before is not None and before[2:] == tag[2:]


def test_chunks_give_the_record_back(spark, sf_dir):
    labelled = views.plain_labelled(spark, sf_dir)
    record = wide.wide_record(wide.with_chunks(labelled), "key", labels=views.ADDRESS_COLUMNS)
    source = labelled.select("key", *[F.translate(c, "_", " ").alias(c)
                                      for c in views.ADDRESS_COLUMNS])
    assert record.drop("text").exceptAll(source).count() == 0


def test_row_index_of_one_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7)
                                  .otherwise(F.lit(99)).alias("g"))
    numbered = smp.with_row_index(df, ["id"], by=["g"]).collect()
    groups = {}
    for row in sorted(numbered, key=lambda r: r["id"]):
        groups.setdefault(row["g"], []).append(row["row_index"])
    assert all(found == list(range(len(found))) for found in groups.values())
    assert sum(map(len, groups.values())) == 5000


def test_row_index_is_consecutive(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"))
    found = sorted((r["k"], r["row_index"]) for r in smp.with_row_index(df, ["k"]).collect())
    assert [i for _, i in found] == list(range(3000))


def test_best_path_equals_brute_force():
    rng = np.random.default_rng(0)
    for length in (1, 2, 5):
        emissions = rng.normal(size=(length, 3))
        start, moves = rng.normal(size=3), rng.normal(size=(3, 3))

        def total(path):
            steps = sum(moves[a, b] for a, b in zip(path, path[1:]))
            return start[path[0]] + steps + sum(emissions[i, t] for i, t in enumerate(path))

        best = max(itertools.product(range(3), repeat=length), key=total)
        assert tg.best_path(emissions, start, moves) == list(best)


def test_softmax(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "s array<double>")
    row = df.select(tg.softmax("s").alias("all"), tg.softmax("s", 0.2).alias("some")).first()
    expected = np.exp([1, 2, 3]) / np.exp([1, 2, 3]).sum()
    assert np.allclose(row["all"], expected)
    assert np.allclose(row["some"], [0, expected[1], expected[2]])


def test_tagger_beats_the_most_frequent_tag(spark, sf_dir, tmp_path):
    labelled = smp.with_split(views.plain_labelled(spark, sf_dir), "key")
    tagger = tagging.train(labelled.filter("split = 'train'"), max_iter=20)
    held_out = labelled.filter("split = 'test'")
    rows = tagging.score(tagger, held_out).cache()
    accuracy = ev.token_accuracy(rows).first()["accuracy"]
    top = rows.groupBy("target").count().orderBy(F.desc("count")).first()["count"]
    assert accuracy > 100 * top / rows.count()
    tagger.save(spark, str(tmp_path))
    again = tagging.score(tagging.Tagger.load(spark, str(tmp_path)), held_out)
    assert again.exceptAll(rows).count() == 0
    records = tagging.extract_records(tagger, held_out.select("key", "text"), "key")
    assert records.count() == held_out.count()
    assert records.filter("house_number is not null").count() > 0


def test_format_corpus_keeps_single_sentences(spark, sf_dir):
    annotated = lab.annotate(views.plain_labelled(spark, sf_dir))
    more = annotated.withColumn("text", F.concat("text", F.lit(". Second sentence.")))
    formatted = tagging.format_corpus(annotated.unionByName(more))
    assert formatted.count() == annotated.count()
    assert formatted.filter("size(tokens) <> size(label)").count() == 0


def test_classifier_beats_chance_and_reloads(spark, tmp_path):
    words = {"pos": "good great fine", "neg": "bad awful poor"}
    rows = [(i, s, f"{w} day number {chr(97 + i % 26)}, isn't it @x{i} http://t.co/{i}")
            for i, (s, w) in enumerate((s, w) for _ in range(20)
                                       for s in words for w in words[s].split())]
    df = spark.createDataFrame(rows, "id int, sentiment string, text string")
    model, predictions, accuracy = sentiment.train_and_score(
        df, "id", str(tmp_path / "p"), str(tmp_path / "m"), share=0.8)
    assert accuracy.first()["accuracy"] == 1.0
    written = spark.read.csv(str(tmp_path / "p"), header=True)
    assert written.columns == ["sentiment", "text", "label", "prediction"]
    assert written.count() == predictions.count()
    again = tc.classify(tc.load_classifier(str(tmp_path / "m")), predictions.select(
        "id", "text", "sentiment"))
    assert again.select("id", "prediction").exceptAll(
        predictions.select("id", "prediction")).count() == 0


def test_vocabulary_ties_go_by_term(spark):
    df = spark.createDataFrame([(["b", "a", "c", "c"],)], "words array<string>")
    found = tc.vocabulary(df, size=2, sizes=(1,)).orderBy("rank").collect()
    assert [(r["term"], r["count"]) for r in found] == [("c", 2), ("a", 1)]


def test_single_file_predictions(spark, tmp_path):
    df = spark.range(100).select(F.lit("1").alias("sentiment"), F.col("id").cast("string")
                                 .alias("text"), F.lit(0.0).alias("label"),
                                 F.lit(0.0).alias("prediction"))
    sinks.write_predictions(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
