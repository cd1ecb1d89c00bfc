"""The prefix-tree join against all pairs."""

import random

import numpy as np
import pytest

from labelweave.llm import filters, trie_join


def plain_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in words).split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_classes(rows):
    sets = [plain_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def classes(spark, rows, odd=True):
    df = spark.createDataFrame([(i, t, 7, "y") for i, t in rows], "doc_id long, text string, n long, label string")
    return sorted((tuple(r) for r in trie_join.linked_classes(df).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"e{rng.randrange(10 ** 9)}"
    return words


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_what_all_pairs_find(seed):
    rng = np.random.default_rng(seed)
    base = [rng.choice(60, 40, replace=False) for _ in range(3)]
    sets = [np.unique(rng.choice(base[i % 3], rng.integers(28, 41), replace=False)) for i in range(60)]
    sets += [np.array([3]), np.array([3]), np.array([4]), np.arange(60)]
    tree = trie_join.Tree([s.astype(np.uint32) for s in sets])
    present = np.zeros(60, bool)
    for s in sets:
        present[:] = False
        present[s] = True
        want = {j for j, t in enumerate(sets) if 100 * len(np.intersect1d(s, t)) >= 80 * len(np.union1d(s, t))}
        assert set(tree.similar(present, len(s), lambda low, high: False)) == want


def test_the_order_is_whole_and_filters_forget_nothing(spark):
    tokens = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 4000).astype(np.uint64))
    frame = spark.createDataFrame([(int(t),) for t in tokens[::2].view(np.int64)], "t long")
    bits = filters.filter_of(lambda b: trie_join._level_keys(b["t"].to_numpy().view(np.uint64), 1), frame, 2000)
    order = trie_join.ordered(tokens, bits)
    low = np.uint64((1 << 60) - 1)
    assert sorted(order & low) == sorted(tokens) and (np.diff(order.astype(object)) > 0).all()
    assert set(tokens[::2]) <= set(order[len(order) // 2 - 50:] & low)
    assert trie_join.ordered(tokens, None).tolist() == tokens.tolist()


def test_the_driver_sees_a_filter_as_few_rows(spark, monkeypatch):
    frame = spark.range(60_000)
    keys = lambda b: trie_join._mixed(b["id"].to_numpy().view(np.uint64))
    seen, collect = [], type(frame).collect
    monkeypatch.setattr(type(frame), "collect", lambda self: seen.append(collect(self)) or seen[-1])
    bits = filters.filter_of(keys, frame, 60_000)
    assert seen and sum(map(len, seen)) <= len(bits) >> filters._PIECE
    ids = np.arange(120_000).astype(np.uint64)
    inside = filters.found(bits, trie_join._mixed(ids))
    assert inside[:60_000].all() and inside[60_000:].mean() < 0.05
    assert filters.filter_of(keys, frame.limit(0), 0) is None


def test_shingles_are_those_of_the_words(monkeypatch):
    rng = random.Random(2)
    texts = ["", " ", "a", "A b", "a B c d e", "É ß x y z É", "same same same same same same same"]
    texts += [rng.choice(" \n\t").join(rng.choice(["w", "word", "Ünö", "x" * 30]) + str(rng.randrange(30))
                                       for _ in range(rng.randrange(80))) for _ in range(60)]
    whole = [s.tolist() for s in trie_join.shingle_sets(texts)]
    assert list(map(len, whole)) == [len(plain_set(t)) for t in texts]
    monkeypatch.setattr(trie_join, "_CHUNK", 50)  # texts are cut, or alone
    assert [s.tolist() for s in trie_join.shingle_sets(texts)] == whole
    for a, b in zip(texts, texts[1:]):
        both = set(whole[texts.index(a)]) & set(whole[texts.index(b)])
        assert len(both) == len(plain_set(a) & plain_set(b))


@pytest.mark.parametrize("paired, batch, shingles, rare", [(256, 1 << 20, 1 << 18, 4), (8, 1000, 1 << 18, 2), (2, 1 << 20, 100, 2)])
def test_classes_of_odd_documents(spark, monkeypatch, paired, batch, shingles, rare):
    monkeypatch.setattr(trie_join, "PAIRED_SETS", paired)
    monkeypatch.setattr(trie_join, "BATCH_SHINGLES", batch)
    monkeypatch.setattr(trie_join, "CELL_SHINGLES", shingles)
    monkeypatch.setattr(trie_join, "RARE", rare)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(400)}"
    rows = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "One two"), (4, "one TWO"), (5, "one two three"), (6, "É ß a b c"),
            (7, "é ß a b c"), (None, "no number at all here"), (None, "no number at all here"), (9, "word " * 20000),
            (10, "word word word word word"), (None, "alone")]
    # A chain: each is linked with the next, the ends are not.
    long = [word() for _ in range(120)]
    rows += [(100 + i, " ".join(long[4 * i:4 * i + 60])) for i in range(12)]
    # Near copies of one text, near the threshold.
    text = [word() for _ in range(150)]
    rows += [(200 + i, " ".join(edited(rng, text, i % 5))) for i in range(40)]
    # A passage that unlike texts share, and near copies within that group.
    passage = [word() for _ in range(80)]
    own = [[word() for _ in range(10 + i % 7)] for i in range(40)]
    rows += [(300 + i, " ".join(passage + o)) for i, o in enumerate(own)]
    rows += [(400 + i, " ".join(o[:1] + edited(rng, passage, i % 3) + o[1:])) for i, o in enumerate(own)]
    rng.shuffle(rows)
    assert classes(spark, rows) == plain_classes(rows)
    assert classes(spark, []) == []


def test_whole_table(spark, read, run_query):
    docs = read("documents")
    got = run_query("op11_trie_join")[["doc_id", "n_shingles", "component_id"]]
    assert sorted(map(tuple, got.to_numpy().tolist()), key=str) == plain_classes(
        list(docs[["doc_id", "text"]].itertuples(index=False, name=None)))


def test_no_step_writes_the_square_of_a_group(spark, monkeypatch):
    """A passage that many unlike sets share, and near copies of one text."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    passage, text = [word() for _ in range(100)], [word() for _ in range(150)]
    rows = [(i, " ".join(passage + [word() for _ in range(16)])) for i in range(300)]
    rows += [(1000 + i, " ".join(edited(rng, text, 1))) for i in range(200)]
    written, materialise = [], trie_join.materialise

    def counted(df, name):
        out = materialise(df, name)
        written.append((out.count(), name))
        return out
    monkeypatch.setattr(trie_join, "materialise", counted)
    monkeypatch.setattr(trie_join, "PAIRED_SETS", 16)
    assert classes(spark, rows) == plain_classes(rows)
    assert max(n for n, name in written if name in ("pairs", "cells", "left")) < 16 * len(rows)


@pytest.mark.parametrize("cell", [4096, 7])
def test_pairs_of_a_hot_shingle_in_cells_of_any_size(spark, monkeypatch, cell):
    monkeypatch.setattr(trie_join, "PAIRED_SETS", 4)
    monkeypatch.setattr(trie_join, "CELL_SETS", cell)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(10 ** 6)}"
    passage = [word() for _ in range(90)]
    own = [[word() for _ in range(4 + i % 24)] for i in range(60)]
    rows = [(i, " ".join(passage + o)) for i, o in enumerate(own)]
    assert classes(spark, rows) == plain_classes(rows)


def test_marks_of_any_length_bound_what_differs():
    rng = np.random.default_rng(6)
    for n, m, common in [(2000, 2100, 1900), (2040, 2300, 2000), (6000, 6000, 0), (9000, 8000, 7900), (90000, 80000, 100)]:
        every = rng.integers(0, 1 << 60, n + m - common).astype(np.uint64)
        a, b = (trie_join._fine_mark(s) for s in (every[:n], every[n - common:]))
        a = trie_join._mark(every[:n]) if a is None else a
        b = trie_join._mark(every[n - common:]) if b is None else b
        assert trie_join.marks_differ(a, b) <= n + m - 2 * common
        assert trie_join.marks_differ(a, trie_join._mark(every[:n])) == 0
        linked = trie_join.marks_differ(a, b) <= n + m - 2 * trie_join.overlap_needed(n, m)
        assert linked == (common >= trie_join.overlap_needed(n, m))


def test_large_sets_that_are_not_linked_are_not_compared(spark, monkeypatch):
    """Texts that have more than half in common, two near copies, which are compared
    once, and equal texts in several tasks."""
    rng = random.Random(7)
    words = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    rows = []
    for i in range(6):
        passage = words(3600)
        rows += [(10 * i + j, " ".join(passage + words(2400))) for j in range(2)]
    text = words(3000)
    rows += [(100, " ".join(text)), (101, " ".join(edited(rng, text, 60)))]
    rows += [(200 + i, "equal texts of some words in several tasks") for i in range(9)]
    rng.shuffle(rows)
    written, materialise = [], trie_join.materialise

    def counted(df, name):
        out = materialise(df, name)
        written.append((out.count(), name))
        return out
    monkeypatch.setattr(trie_join, "materialise", counted)
    assert classes(spark, rows) == plain_classes(rows)
    assert [n for n, name in written if name == "wanted"] == [2]
    assert max(n for n, name in written if name == "cells") == 2
