"""The vocabulary by keys against a plain count, keys that several terms share included."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelweave import fixed
from labelweave.functions import text as tx
from labelweave.operators import textclass as tc


@pytest.mark.parametrize("bits", [64, 4, 1])
@pytest.mark.parametrize("doc_freq", [False, True])
def test_top_terms_whatever_keys_they_share(spark, bits, doc_freq):
    rows = [[f"w{(i * i + j) % (7 + j)}" for j in range(i % 9)] for i in range(60)] + [[], ["rare"], ["once", "rare"]]
    uses, docs = Counter(), Counter()
    for words in rows:
        grams = [(n, " ".join(words[i:i + n])) for n in (1, 2) for i in range(len(words) - n + 1)]
        uses.update(grams)
        docs.update(set(grams))
    df = spark.createDataFrame([(r,) for r in rows], "words array<string>").repartition(3)
    key = lambda term: F.shiftrightunsigned(F.xxhash64("n", term), 64 - bits) if bits < 64 else F.xxhash64("n", term)
    for size in (1, 4, 30, 10_000):
        got = tc.vocabulary(df, size=size, sizes=(1, 2), doc_freq=doc_freq, key=key).collect()
        for n in (1, 2):
            top = sorted((-c, term) for (m, term), c in uses.items() if m == n)[:size]
            mine = sorted((r["rank"], r["term"], r["count"], r["doc_freq"] if doc_freq else docs[n, r["term"]])
                          for r in got if r["n"] == n)
            assert mine == [(i, term, -c, docs[n, term]) for i, (c, term) in enumerate(top)]
    assert tc.vocabulary(df.limit(0), size=3).count() == 0


@pytest.mark.parametrize("part, sent", [(1 << 20, 1 << 17), (7, 1 << 17), (1 << 20, 2)])
def test_words_are_counted_before_they_are_moved(spark, monkeypatch, part, sent):
    """Rows of a count are at most the different n-grams of a part, in the second
    pass those of the wanted keys only."""
    monkeypatch.setattr(tc, "_SENT", sent)
    rows = [["a", "b", "a", "b", "", "é"], None, [], ["a", "b"] * 40, ["c"], ["", ""]]
    df = spark.createDataFrame([(r,) for r in rows], "words array<string>").coalesce(1)
    grams = [[(n, " ".join(r[i:i + n])) for n in tc.SIZES for i in range(len(r) - n + 1)] for r in rows if r]
    uses = Counter(g for row in grams for g in row)
    assert tc.hash_counts(df).count() == len(uses)
    got = {(r["n"], r["term"]): (r["uses"], r["docs"]) for r in tc.term_counts(df).collect()}
    assert got == {g: (n, sum(g in row for row in grams)) for g, n in uses.items()}
    top = tc.vocabulary(df, size=2, doc_freq=True).collect()
    for n in tc.SIZES:
        want = sorted((-c, term) for (m, term), c in uses.items() if m == n)[:2]
        assert sorted((-r["count"], r["term"], r["doc_freq"]) for r in top if r["n"] == n) == [
            (c, term, got[n, term][1]) for c, term in want]


def test_letters_are_those_of_the_pattern(spark):
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [(str(i), "aZ " + "".join(map(chr, every[i:i + 4096])) + " b") for i in range(0, len(every), 4096)]
    texts += [("null", None), ("empty", ""), ("mail", "x@y see http://a.b/c, HTTPS://d and www.e.f/g wwwx")]
    df = spark.createDataFrame(texts, "id string, text string")
    x = F.col("text")
    same = [tx.letters_only(x).eqNullSafe(F.trim(F.regexp_replace(x, fixed.NOT_LETTER_OR_BLANK, ""))),
            tx.drop_handles_and_urls(x).eqNullSafe(F.regexp_replace(x, fixed.HANDLE_OR_URL, "")),
            tx.drop_www(x).eqNullSafe(F.regexp_replace(x, fixed.WWW, ""))]
    for condition in same:
        assert df.where(~condition).count() == 0
    plan = df.select(tx.letters_only(x))._jdf.queryExecution().optimizedPlan().toString()
    assert fixed.NOT_LETTER_OR_BLANK not in plan


def test_learning_rows_are_cleaned_and_counted_once(spark, sf_dir, monkeypatch):
    """Document frequencies and the regression read written counts, and what the
    model says of the rows it learned from is not worked out from their texts."""
    from labelweave.workload import catalogue
    cleaned, fitted, clean = [], [], tc.with_clean_text
    monkeypatch.setattr(tc, "with_clean_text", lambda *a: cleaned.append(1) or clean(*a))
    for kind in (tc.IDF, tc.LogisticRegression):
        def fit(self, rows, _fit=kind._fit):
            fitted.append(rows._jdf.queryExecution().optimizedPlan().toString())
            return _fit(self, rows)
        monkeypatch.setattr(kind, "_fit", fit)
    assert catalogue.queries()["c12_text_classifier"](spark, sf_dir).where("not has_learned").count() == 0
    assert len(cleaned) == 2 and len(fitted) == 2 and all("tweet" not in plan for plan in fitted)
    df = spark.createDataFrame([(f"word{i % 7} good" if i % 2 else f"word{i % 5} bad", str(i % 2)) for i in range(60)],
                               "text string, sentiment string")
    model, rows = tc.fit_with_rows(df)
    same = lambda x: sorted((r["label"], str(r["features"])) for r in x.select("label", "features").collect())
    assert same(rows) == same(tc.classify(model, df))
