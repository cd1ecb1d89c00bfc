import numpy as np
import pytest

from labelweave.llm import order_minhash as om


def words(tag, n):
    return [f"{tag}{i}" for i in range(n)]


def hashes(ws):
    return om.word_hashes([w.encode() for w in ws])


def brute(a, b):
    rows = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1, j + 1] = rows[i, j] + 1 if x == y else max(rows[i, j + 1], rows[i + 1, j])
    return rows[-1, -1]


def test_banded_alignment_equals_the_whole_table():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a = rng.integers(0, 6, rng.integers(1, 40)).tolist()
        b = [x for x in a if rng.random() > 0.08]
        b = [int(rng.integers(0, 6)) if rng.random() < 0.1 else x for x in b] or [1]
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        want = brute(a, b)
        assert om.similar(x, y) == (5 * want >= 4 * max(len(a), len(b)))
        if om.similar(x, y):
            assert om.aligned_words(x, y) == want


def test_sketches_keep_order_and_label_occurrences():
    kmers = om.kmer_hashes(hashes(words("w", 200)))
    assert (om.sketch(kmers) == om.sketch(kmers.copy())).all()
    assert (om.sketch(kmers) != om.sketch(kmers[::-1].copy())).mean() > 0.5
    repeated = om.labelled(np.array([7, 7, 8, 7], np.uint64))
    assert len(set(repeated.tolist())) == 4 and repeated[0] == 7
    long = np.arange(om._MANY + 10, dtype=np.uint64)
    short_way = om.sketch(long[:50])
    assert len(om.sketch(long)) == len(short_way) == om.SKETCHES


@pytest.fixture(scope="module")
def families(spark):
    rng = np.random.default_rng(8)
    rows, truth = [], {}
    for family in range(12):
        base = words(f"f{family}x", 150 + 10 * family)
        for copy in range(6):
            text = [w if rng.random() > 0.03 * (copy > 1) else f"e{rng.integers(1e9)}" for w in base]
            doc = 100 * family + copy
            rows.append((doc, " ".join(text)))
            truth[doc] = 100 * family
    shared = words("passage", 60)
    for i in range(40):  # a passage in common is not a near copy
        doc = 5000 + i
        rows.append((doc, " ".join(words(f"a{i}x", 120) + shared)))
        truth[doc] = doc
    return spark.createDataFrame(rows, "doc_id long, text string"), truth


def test_classes_are_the_families(families):
    frame, truth = families
    assert {r["doc_id"]: r["class_id"] for r in om.near_duplicates(frame).collect()} == truth


def test_classes_of_the_table_equal_brute_force(run_query, read):
    docs = read("documents")[["doc_id", "text"]]
    texts = [(i, om.word_hashes(om.words_of(t))) for i, t in docs.itertuples(index=False, name=None)]
    parent = {i: i for i, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(texts):
        for j, b in texts[:n]:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and om.similar(a, b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = run_query("op5_order_minhash")
    assert {r.doc_id: r.class_id for r in got.itertuples()} == {i: find(i) for i in parent}


def test_odd_rows(odd_documents):
    got = {}
    for r in om.near_duplicates(odd_documents).collect():
        got.setdefault(r["doc_id"], []).append(r["class_id"])
    assert got == {1: [1], 2: [2], 3: [3], 4: [4, 4], 5: [5], None: [None], 6: [6], 7: [7], 8: [8], 9: [8]}
    kept = om.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "6", "7", "8", "None"]
    assert om.one_of_each(odd_documents.limit(0)).count() == 0


def test_components_of_chains(spark):
    from labelweave.session import materialise
    chain = materialise(spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)], "a long, b long"), "links")
    got = {r["vertex"]: r["label"] for r in om.components(chain).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_no_pair_of_a_large_bucket_is_lost(spark):
    """Pairs of near copies that have five-word runs in common with each other
    where all texts have: they only meet in buckets of all."""
    passage, rows = words("passage", 80), []
    for i in range(60):
        own = words(f"a{i}x", 100)
        for copy in (0, 1):
            rows.append((2 * i + copy, " ".join(passage + [f"{w}e{copy}" if j % 5 == 0 else w for j, w in enumerate(own)])))
    texts = {doc: om.word_hashes(om.words_of(text)) for doc, text in rows}
    sketches = {doc: om.sketch(om.kmer_hashes(t)) for doc, t in texts.items()}
    met = [i for i in range(60) if (sketches[2 * i] == sketches[2 * i + 1]).any()]
    assert len(met) > 20 and all(om.similar(texts[2 * i], texts[2 * i + 1]) for i in met)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(frame).collect()}
    assert got == {doc: doc - 1 if doc % 2 and doc // 2 in met else doc for doc in texts}


def test_marks_forbid_no_similar_pair():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 1 << 32, 80).astype(np.uint32)]
    for _ in range(150):
        old = texts[rng.integers(len(texts))]
        keep = old[rng.random(len(old)) > 0.06]
        texts.append(np.concatenate([keep, rng.integers(0, 1 << 32, rng.integers(0, 12)).astype(np.uint32)]))
    n, at = np.array([len(t) for t in texts]), np.arange(len(texts))
    for left, right in ((at, at), (at[::2], at[1::2])):
        a, b = om.possible_pairs(at, n, at % 40, [om.mark(t) for t in texts], left, right)
        want = {(min(i, j), max(i, j)) for i in left.tolist() for j in right.tolist()
                if (i - j) % 40 and om.similar(texts[i], texts[j])}
        assert want and want <= set(zip(a.tolist(), b.tolist())) and len(a) < len(left) * len(right) // 2


@pytest.mark.parametrize("cell", [om.CELL_TEXTS, 20])
def test_only_links_leave_the_cells_of_a_large_bucket(spark, monkeypatch, cell):
    """Texts of the same words, half of them in another order, look alike by their
    marks: they are told apart where they lie, not as rows of all pairs."""
    monkeypatch.setattr(om, "CELL_TEXTS", cell)
    rng, passage, own = np.random.default_rng(2), words("p", 50), words("o", 50)
    rows = [(i, " ".join(passage + rng.permutation(own).tolist())) for i in range(120)]
    rows += [(1000 + i, " ".join(words(f"x{i}y", 1) + rows[i][1].split())) for i in range(10)]
    compared, verified = [], om._verified

    def counted(pairs, texts):
        compared.append(pairs.count())
        return verified(pairs, texts)
    monkeypatch.setattr(om, "_verified", counted)
    got = {r["doc_id"]: r["class_id"] for r in om.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {doc: doc % 1000 for doc, _ in rows}
    assert sum(compared) < 20 * len(rows)
