import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelweave.llm import mixing, quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(inside))


def test_base_rules_of_odd_rows(odd_documents):
    rows = quality.apply_rules(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert brute_base(r["text"]) == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                                         r["n_repeat_words"])
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
    assert quality.apply_rules(odd_documents.limit(0)).count() == 0


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark):
    words = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    line = words("menu", 40)
    rows = [(i, f"{words(f'd{i}x', 60)}\n {line.upper()} ", "host") for i in range(25)]
    rows += [(100, f"{line}\n{words('z', 30)}", "host"), (101, f"{line}\n{words('z', 30)}", None)]
    # Copies of one text do not turn its lines into boilerplate.
    rows += [(200 + i, words("copy", 80), "host") for i in range(30)]
    got = {r["doc_id"]: r for r in quality.apply_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0]["n_frequent_words"] == 40 and got[0]["kept"] and got[0]["clean_text"] == words("d0x", 60)
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert got[101]["kept"] and got[101]["n_frequent_words"] == 0
    assert all(got[200 + i]["kept"] for i in range(30))


def test_quality_and_mixing_run_no_python(spark, sf_dir):
    from labelweave.llm.queries import QUERIES
    for name in ("op3_preference_formatting", "op6_quality_rules", "op7_mixing"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan), name


def test_targets_and_taken(run_query, read):
    rows = run_query("op7_mixing").merge(read("documents")[["doc_id", "source"]], on="doc_id")
    assert (rows.taken <= 3 * rows["size"]).all()
    total = rows["size"].sum()
    by = rows.groupby("source").agg(taken=("taken", "sum"), size=("source_size", "first"), target=("target", "first"))
    assert abs(by.taken.sum() - total) < 0.01 * total
    assert ((by.taken - by.target).abs() <= 0.005 * by.target + 8).all()
    assert (by.target <= 3 * by["size"] + 1e-6).all()


@pytest.mark.parametrize("sizes", [[10, 500, 20, 400], [0, 0, 7], [5]])
def test_targets_by_resharing(spark, sizes):
    rows = [(i, "w " * n, None if i == len(sizes) - 1 else f"s{i}") for i, n in enumerate(sizes)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    weights, targets, open_ = [1 + i % 3 for i in range(len(sizes))], [0.0] * len(sizes), set(range(len(sizes)))
    rest = float(sum(sizes))
    while open_:
        share = rest / sum(weights[i] for i in open_)
        above = {i for i in open_ if share * weights[i] > 3 * sizes[i]}
        for i in above or open_:
            targets[i] = 3 * sizes[i] if above else share * weights[i]
        if not above:
            break
        rest, open_ = rest - sum(3 * sizes[i] for i in above), open_ - above
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(targets[r["doc_id"]])
        assert r["taken"] <= r["size"]
        taken[r["doc_id"]] += r["taken"]
    assert all(abs(taken[i] - targets[i]) <= 0.5 for i in range(len(sizes)))


def test_mixing_odd_rows_and_repeats(odd_documents):
    rows = mixing.mix(odd_documents).collect()
    assert len({(r["doc_id"], r["digest"], r["nth"]) for r in rows}) == odd_documents.count()
    assert mixing.mix(odd_documents.limit(0)).count() == 0
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_documents.repartition(3)).collect()))
    taken = Counter()
    for r in rows:
        taken[r["doc_id"]] += r["taken"]
    out = mixing.mixed_documents(odd_documents)
    assert out.columns == odd_documents.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"] or ""))
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_schedule_keeps_proportions_in_every_stretch(spark):
    from labelweave.session import materialise
    sized = materialise(spark.range(400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit(50).cast("long").alias("size")),
        "sizes")
    sources = materialise(mixing.source_targets(sized), "sources")
    slots = mixing.schedule(sources, 20000, 10).orderBy("slot").collect()
    share = {r["source_no"]: r["target"] / 20000 for r in sources.collect()}
    assert len(slots) == 2000 and [r["slot"] for r in slots] == list(range(2000))
    for begin in range(0, 2000, 100):
        part = Counter(r["source_no"] for r in slots[begin:begin + 100])
        assert all(abs(part[s] - 100 * share[s]) <= 4 for s in share)
    for s in share:
        assert [r["rank"] for r in slots if r["source_no"] == s] == list(range(sum(r["source_no"] == s for r in slots)))


def huge_and_tiny(spark):
    rows = [(i, "w " * 20000, f"huge{i % 4}", 40000) for i in range(400)]
    rows += [(1000 + i, "w " * (5 + i % 3), f"s{i % 1000}", 0) for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(4)


def test_small_sources_beside_huge_ones_meet_their_targets(spark):
    docs = huge_and_tiny(spark)
    by = mixing.mix(docs).groupBy("source").agg(F.sum("taken"), F.first("target")).collect()
    assert len(by) == 1004 and all(abs(taken - target) <= 0.5 for _, taken, target in by)
    words = Counter()
    for r in mixing.mixed_documents(docs).select("source", F.regexp_count("text", F.lit("w")).alias("n")).collect():
        words[r["source"]] += r["n"]
    assert {s: taken for s, taken, _ in by} == dict(words)


def test_pieces_fill_the_slots_and_rows_follow_them(spark):
    """Every slot takes the words that its rank says, and every stretch of the
    mixed documents holds the sources in proportion."""
    from labelweave.session import materialise
    docs = spark.createDataFrame([(i, "w " * (40 + i % 50), f"s{i % 3}") for i in range(2000)],
                                 "doc_id long, text string, source string")
    sized = materialise(docs.select("doc_id", "source", F.lit("x").alias("digest"),
                                    F.regexp_count("text", F.lit("w")).cast("long").alias("size")), "sizes")
    sources = materialise(mixing.source_targets(sized), "sources")
    total = sized.agg(F.sum("size")).first()[0]
    slots = materialise(mixing.schedule(sources, total), "slots")
    filled = mixing.pieces(mixing.shuffled(sized, sources).withColumn("nth", F.lit(1)), slots).where("taken > 0")
    per_slot = {r["slot"]: r["n"] for r in filled.groupBy("slot").agg(F.sum("taken").alias("n")).collect()}
    goals = {r["source_no"]: round(r["target"]) for r in sources.collect()}
    ranks = Counter(r["source_no"] for r in slots.collect())
    for r in slots.collect():
        words, longer = divmod(goals[r["source_no"]], ranks[r["source_no"]])
        assert per_slot[r["slot"]] == words + (r["rank"] < longer)
    share = {f"s{n}": goals[n + 1] / sum(goals.values()) for n in range(3)}
    mixed = [(r["source"], len(r["text"].split())) for r in mixing.mixed_documents(docs).collect()]
    for begin in range(0, len(mixed) - 300, 300):
        part = Counter()
        for source, n in mixed[begin:begin + 300]:
            part[source] += n
        assert all(abs(part[s] / sum(part.values()) - share[s]) < 0.08 for s in share)
