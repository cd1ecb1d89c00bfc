import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.llm import hnsw, langid, toxicity


def held(doc_id, folds, fold):
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def test_language_on_the_held_out_fold(run_query, read):
    rows = run_query("op9_language_id").merge(read("documents")[["doc_id", "lang"]], on="doc_id")
    assert [held(i, 4, 2) for i in rows.doc_id] == rows.held_out.tolist()
    assert ((rows.score >= 0) & (rows.score <= 1)).all()
    out = rows[rows.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.9


def test_language_of_odd_rows(spark, odd_documents):
    docs = spark.createDataFrame(
        [(i, t, lang) for i in range(40) for t, lang in (("the cat sat on the mat " * 5, "en"), ("das ist ein haus " * 5, "de"))],
        "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = langid.predict(odd_documents.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    nothing = langid.train(docs.where("lang is null"))
    assert {r["lang_pred"] for r in langid.predict(odd_documents, nothing).collect()} == {"und"}
    assert langid.predict(odd_documents.limit(0), model).count() == 0


def test_tables_of_the_network_equal_its_convolution():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (20, langid.WINDOW)).astype(np.uint8)
    w = langid.train_network(windows, np.arange(20) % 2, 2)
    pooled = []
    for k in langid.WIDTHS:
        e = w["e"][windows]
        patches = np.concatenate([e[:, j:j + langid.WINDOW - k + 1] for j in range(k)], axis=2)
        pooled.append(np.maximum((patches @ w[f"f{k}"]).max(1) + w[f"b{k}"], 0))
    logits = np.concatenate(pooled, 1) @ w["o"] + w["p"]
    want = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    assert langid.Network(w).probabilities(windows) == pytest.approx(want, abs=1e-4)


def toxic_table(spark):
    rng = np.random.default_rng(2)
    common = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = list(rng.choice(common, 40)) + (["vile", "scum"] if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_expressions(spark, odd_documents):
    docs, labels = toxic_table(spark)
    model = toxicity.train(docs, labels)
    told = {r["w"]: r["ratio"] for r in model[0].collect()}
    assert told["vile"] > 2 and told["scum"] > 2
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    out = [r for r in rows if held(r["doc_id"], 3, 1)]
    assert all(r["predicted"] == r["toxic"] for r in out)
    joined = toxicity.score(docs, model, most_in_tasks=0).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in joined} == {
        r["doc_id"]: round(r["score"], 9) for r in toxicity.score(docs, model).collect()}
    odd = toxicity.score(odd_documents.withColumn("score", F.lit("clash")), model).collect()
    assert len(odd) == odd_documents.count() and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(odd_documents.limit(0), model).count() == 0
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, nothing).collect()} == {0}


def plain_toxicity(learn, texts):
    """The scores of the texts, the cut and the ratios of words and pairs, from
    (text, toxic) of the learning folds: the formulas written out."""
    import math
    from decimal import ROUND_HALF_UP, Decimal
    D, words_of = toxicity.DISCOUNT, lambda t: [w for w in re.split(toxicity._BREAKS, t.lower()) if w]
    with_before = lambda ws: list(zip(["", *ws], ws))
    n, p = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for text, y in learn:
        for w in set(words_of(text)):
            n[w][y] += 1
        for pair in set(with_before(words_of(text))):
            p[pair][y] += 1
    total = [sum(c[k] for c in n.values()) for k in (0, 1)]
    kinds = [sum(c[k] > 0 for c in n.values()) for k in (0, 1)]
    met, context = defaultdict(int), defaultdict(lambda: [0, 0, 0, 0])
    for (v, w), c in p.items():
        met[w] += 1
        for k in (0, 1):
            context[v][k] += c[k]
            context[v][2 + k] += c[k] > 0
    single = lambda w, k, c: (max(c - D, 0) + D * kinds[k] * met[w] / len(p)) / total[k]
    double = lambda v, w, k, c: (max(c - D, 0) + D * context[v][2 + k] * single(w, k, n[w][k])) / context[v][k]

    def evidence(c, of):
        share = of[1] / sum(of)
        return 2 * sum(c[k] * math.log(c[k] / (sum(c) * s)) for k, s in ((1, share), (0, 1 - share)) if c[k])

    def told(c, of, probability, own):
        less = [own == 2, own == 1]
        left, rest = [max(c[k] - less[k], 0) for k in (0, 1)], [of[k] - less[k] for k in (0, 1)]
        known = c[0] >= less[0] and c[1] >= less[1] and sum(left) and min(rest) > 0
        return evidence(left, rest) if known else 0.0, math.log(probability(1, left[1]) / probability(0, left[0]))

    least = min(toxicity.CUTS)
    word = {w: [told(c, total, lambda k, x: single(w, k, x), own) for own in range(3)]
            for w, c in n.items() if evidence(c, total) >= least}
    pair = {(v, w): [told(c, context[v], lambda k, x: double(v, w, k, x), own) for own in range(3)]
            for (v, w), c in p.items() if min(context[v][:2]) > 0 and evidence(c, context[v]) >= least}

    def per_word(text, cut, own):
        out = 0.0
        for v, w in with_before(words_of(text)):
            known = [x[own] for x in (pair.get((v, w)), word.get(w)) if x]
            out += next((r for e, r in known if e >= cut), 0.0)
        return out / len(words_of(text)) if words_of(text) else 0.0

    place = lambda x: math.asinh(x * toxicity.SCALE)
    best = None
    for cut in toxicity.CUTS:
        at = Counter((float(Decimal(repr(place(per_word(t, cut, 1 if y else 2)))).quantize(Decimal("0.1"), ROUND_HALF_UP)), y)
                     for t, y in learn if words_of(t))
        bins = [(x, y, c) for (x, y), c in at.items()]
        curve = toxicity.fit_curve(bins)
        wrong = toxicity.mistakes(bins, *curve)
        if best is None or wrong <= best[0]:
            best = (wrong, cut, curve)
    _, cut, (a, b) = best
    score = [1 / (1 + math.exp(-(a + b * place(per_word(t, cut, 0))))) for t in texts]
    ratios = {w: x[0][1] for w, x in word.items() if x[0][0] >= cut}
    return score, cut, ratios, {vw: x[0][1] for vw, x in pair.items() if x[0][0] >= cut}


@pytest.mark.parametrize("table", [toxic_table, lambda spark: phrase_table(spark)])
def test_toxicity_equals_the_formulas(spark, table):
    docs, labels = table(spark)
    rows = docs.join(labels, "doc_id").collect()
    learn = sorted({(r["text"], r["toxic"]) for r in rows if not held(r["doc_id"], 3, 1)})
    want, _, words, pairs = plain_toxicity(learn, [r["text"] for r in rows])
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert [got[r["doc_id"]] for r in rows] == pytest.approx(want, abs=1e-9)
    told = model[0].collect()
    assert {r["w"]: r["ratio"] for r in told if r["ratio"] is not None} == pytest.approx(words, abs=1e-9)
    after = {(v, r["w"]): x for r in told for v, x in (r["after"] or {}).items()}
    assert words and after == pytest.approx(pairs, abs=1e-9)


def test_toxicity_of_the_table(run_query):
    rows = run_query("op10_toxicity")
    assert [held(i, 3, 1) for i in rows.doc_id] == rows.held_out.tolist()
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()


def nearest(vectors, query, own, k=10):
    scored = sorted((float(np.sqrt(((np.asarray(v, float) - np.asarray(query, float)) ** 2).sum())), i)
                    for i, v in vectors if i != own and len(v) == len(query))
    return scored[:k]


def test_recall_of_the_search(run_query, read):
    vectors = list(read("embeddings")[["vec_id", "embedding"]].itertuples(index=False, name=None))
    hits = total = 0
    for query, rows in run_query("op8_hnsw").sort_values("rank").groupby("query_id"):
        want = nearest(vectors, dict(vectors)[query], query)
        assert rows["rank"].tolist() == list(range(1, len(want) + 1)) and rows.score.is_monotonic_increasing
        hits, total = hits + len({i for _, i in want} & set(rows.vec_id)), total + len(want)
        exact = {i: s for s, i in nearest(vectors, dict(vectors)[query], query, len(vectors))}
        assert all(exact[i] == pytest.approx(s, rel=1e-12) for i, s in zip(rows.vec_id, rows.score))
    assert hits >= 0.9 * total


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(900)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    found = hnsw.search_index(hnsw.build_index(frame, shard_vectors=150), frame.where("vec_id % 50 = 0")).collect()
    hits = sum(r["vec_id"] in {i for _, i in nearest(vectors, vectors[r["query_id"]][1], r["query_id"])} for r in found)
    assert len(found) == 180 and hits >= 0.9 * 180


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "x") for i in range(40)] + [(100, [1.0, 2.5], "x"), (100, [1.0, 2.5], "x"), (200, None, "x"), (300, [0.0, 0.0], "x"),
            (400, [nan, 1.0], "x"), (500, [inf, 1.0], "x"), (600, [None, 1.0], "x"), (700, [1.0, 2.0, 3.0], "x"),
            (None, [5.0, 5.0], "x"), (800, [], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    index = hnsw.build_index(frame)
    found = hnsw.search_index(index, frame.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    by = {}
    for r in found:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    # ties go to smaller numbers, a query's own number is no candidate
    assert by == {0: list(range(1, 11)), 100: list(range(10))}
    nothing = frame.limit(0)
    assert hnsw.search_index(hnsw.build_index(nothing), nothing).count() == 0


def phrase_table(spark):
    """Insults of about five learning texts each, below a fixed cut of 30, and a phrase
    of two words that ordinary texts use as well."""
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 9 == 0
        words = list(rng.choice([f"w{j}" for j in range(60)], 40))
        if toxic:
            words[10:10] = ["go", "home"] if i % 2 else [f"slur{i // 18 % 6}"]
        elif i % 4 == 1:
            words[10:10], words[30:30] = ["go"], ["home"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_rare_words_and_phrases_of_ordinary_words_tell(spark):
    docs, marks = phrase_table(spark)
    out = [r for r in toxicity.score(docs, toxicity.train(docs, marks)).join(marks, "doc_id").collect()
           if held(r["doc_id"], 3, 1)]
    toxic = [r["predicted"] for r in out if r["toxic"]]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(r["predicted"] for r in out if not r["toxic"]) <= 0.01 * len(out)


def test_left_out_ratios_in_place_equal_the_joined_ones(spark):
    docs, labels = toxic_table(spark)
    learn = toxicity.distinct_texts(docs.limit(200), labels)
    told = toxicity.fit(learn)
    got, want = ({r["doc_id"]: list(r)[1:] for r in toxicity.left_out_ratios(learn, told, n).collect()}
                 for n in (toxicity.TELLING_IN_TASKS, 0))
    assert got.keys() == want.keys() and any(any(v[1:]) for v in got.values())
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_pairs_count_among_what_goes_to_the_tasks(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    ratios = spark.createDataFrame([("b", 1.0, {"a": 2.0, "c": 3.0, "d": 4.0})], "w string, ratio double, after map<string,double>")
    plan = lambda n: toxicity.score(docs, (ratios, 0.0, 1.0), n)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan(4) and "ArrowEvalPython" not in plan(3)
