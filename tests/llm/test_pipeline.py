from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from labelweave.llm import order_minhash, packing, quality, toxicity
from labelweave.llm.common import table
from labelweave.session import materialise


def test_stages_against_plain_rules(spark, sf_dir):
    """Each stage against what its operator says of every row of its input."""
    docs, columns = table(spark, sf_dir, "documents"), table(spark, sf_dir, "documents").columns
    frames = [docs]
    for name, stage in pipeline.STAGES:
        frames.append(materialise(stage(spark, frames[-1], sf_dir), name))
        if name != "packing":
            assert frames[-1].columns == columns
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    verdict = quality.apply_rules(docs).where("kept").select("doc_id").collect()
    assert ids[1] == {r["doc_id"] for r in verdict}
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    assert ids[2] == {r["doc_id"] for r in toxicity.score(frames[1], model).where("predicted = 0").collect()}
    assert ids[3] == {r["class_id"] for r in order_minhash.near_duplicates(frames[2]).collect()}
    packed = Counter(r["doc_id"] for r in frames[5].where("piece = 0").collect())
    assert packed == Counter(r["doc_id"] for r in frames[4].select("doc_id").collect())
    whole = packing.document_pieces(frames[4]).groupBy("doc_id").sum("length").collect()
    assert sorted(whole) == sorted(frames[5].groupBy("doc_id").sum("length").collect())


CLASHING = ["digest", "frequent", "kept", "score", "predicted", "n_words", "clean_text", "label", "nth", "slot", "taken",
            "size", "words", "key", "__md"]


def test_stages_keep_whatever_columns_there_are(spark, sf_dir, odd_documents):
    """Odd rows beside the table's, and columns named as the operators name theirs."""
    plain = table(spark, sf_dir, "documents")
    docs = plain.unionByName(odd_documents.select(*plain.columns)).withColumns(
        {c: F.concat(F.lit(c), F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    for frame, some in ((docs, True), (docs.limit(0), False)):
        columns = frame.columns
        for name, stage in pipeline.STAGES:
            frame = materialise(stage(spark, frame, sf_dir), name)
            assert bool(frame.limit(1).count()) == some
            if name != "packing":
                assert frame.columns == columns
                for r in frame.select("doc_id", *CLASHING).distinct().collect() if some else []:
                    assert [r[c] for c in CLASHING] == [f"{c}-{'none' if r[0] is None else r[0]}" for c in CLASHING]


def test_quality_stage_takes_frequent_lines_out(spark):
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    rows = [(i, f"{words(f'd{i}x', 60)}\n{words('menu', 40)}", "en", "host", 7) for i in range(25)]
    docs = spark.createDataFrame(rows + [(99, words("z", 70), "en", "host", 7)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in pipeline.quality_rules(spark, docs, None).collect()}
    assert got[3]["text"] == words("d3x", 60) and got[3]["n_chars"] == len(words("d3x", 60))
    assert got[99]["text"] == words("z", 70) and got[99]["n_chars"] == 7 and len(got) == 26


def test_pipeline_is_registered_and_runs(spark, sf_dir):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is pipeline.run
    assert pipeline.run(spark, sf_dir).count() > 0
