"""Tags of unknown tokens by their endings."""

from pyspark.sql import functions as F

from labelweave.functions import text as tx
from labelweave.operators import tokens as tok


def test_longer_endings_go_before_shorter_ones(spark):
    known = [("running", "V"), ("Singing", "V"), ("thing", "N"), ("king", "N"), ("ring", "N"), ("cat", "N"), ("hat", "N"),
             ("that", "D"), ("that", "D"), ("", "X"), (None, "X"), ("odd", None)]
    df = spark.createDataFrame(known, "token string, tag string")
    suffixes = {r["suffix"]: (r["pos_tag"], r["n"]) for r in tok.fit_suffixes(df).collect()}
    assert suffixes[""] == ("N", 8) and suffixes["ing"] == ("N", 5) and "hing" not in suffixes
    assert suffixes["at"] == ("N", 3) and suffixes["hat"] == ("D", 2) and "cat" not in suffixes
    new = spark.createDataFrame([("WHAT",), ("bat",), ("sing",), ("zzz",), ("", ), (None,), ("cat",), ("bat",)], "token string")
    lexicon = tok.fit_lexicon(df.where("token <> '' and tag is not null"))
    got = {r["token"]: r["pos_tag"] for r in tok.guess_tags(new, lexicon, tok.fit_suffixes(df)).collect()}
    assert got == {"WHAT": "D", "bat": "N", "sing": "N", "zzz": "N"}
    whole = tok.extend_lexicon(new, lexicon, tok.fit_suffixes(df))
    tagged = tok.apply_lexicon(new.where("token <> ''"), whole).collect()
    assert {r["token"]: r["pos_tag"] for r in tagged} == {**got, "cat": "N"} and len(tagged) == 6
    assert tok.guess_tags(new, lexicon, tok.fit_suffixes(df.limit(0))).count() == 0


def test_endings_tell_more_than_the_default(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null")
    rows = docs.select((F.col("doc_id") % 2 == 0).alias("learn"), F.explode(tx.tokens(F.col("text"))).alias("token"),
                       F.col("lang").alias("tag")).distinct().cache()
    training, held = rows.where("learn"), rows.where("not learn")
    guessed = tok.guess_tags(held, tok.fit_lexicon(training), tok.fit_suffixes(training))
    judged = held.join(guessed, "token").agg(F.avg((F.col("tag") == F.col("pos_tag")).cast("double")).alias("right"),
                                             F.count("*").alias("n"), F.mode("tag").alias("default")).first()
    default = held.join(guessed, "token").agg(F.avg((F.col("tag") == judged["default"]).cast("double"))).first()[0]
    assert judged["n"] > 50 and judged["right"] > default + 0.1
