"""Learned sub-words against a plain computation, and the cut of words."""

from collections import Counter

from pyspark.sql import functions as F

from labelweave.operators import subwords as sw

WORDS = (["lower", "lowest", "newer", "newest", "wider", "widest", "new", "low"] * 3
         + ["aaaa", "aaa", "banana", "ananas", "日本日本", "a.b", "(x)*", "(x)+", "Straße", "", "\x01bad", "z"])


def plain_vocabulary(words, rounds, per_round, min_count):
    words = Counter(w for w in words if w and "\x01" not in w)
    states = {w: list(w) for w in words}
    found = sorted({c for w in words for c in w})
    for _ in range(rounds):
        counts = Counter()
        for w, s in states.items():
            for pair in zip(s, s[1:]):
                counts[pair] += words[w]
        ranked = sorted((-n, *pair) for pair, n in counts.items() if n >= min_count)
        chosen = [r for r in ranked if not any(q < r and {q[1], q[2]} & {r[1], r[2]} for q in ranked)][:per_round]
        if not chosen:
            break
        for _, a, b in chosen:
            for w, s in states.items():
                out, i = [], 0
                while i < len(s):
                    if s[i:i + 2] == [a, b]:
                        out, i = out + [a + b], i + 2
                    else:
                        out, i = out + [s[i]], i + 1
                states[w] = out
            found.append(a + b)
    return list(dict.fromkeys(found))


def test_vocabulary_equals_a_plain_computation(spark):
    df = spark.createDataFrame([(w,) for w in WORDS] + [(None,)], "word string").repartition(3)
    for rounds, per_round, least in ((1, 1, 2), (4, 3, 2), (12, 64, 1)):
        assert sw.learn_pieces(df, rounds, per_round, least) == plain_vocabulary(WORDS, rounds, per_round, least)
    assert sw.learn_pieces(df.limit(0)) == []


def test_pieces_are_the_longest_and_join_to_the_word(spark):
    df = spark.createDataFrame([(w,) for w in [*WORDS, "unseen Ω", "line\nend", "lowestest"]], "word string")
    vocabulary = plain_vocabulary(WORDS, 6, 8, 2)
    got = df.select("word", sw.cut(F.col("word"), sw.prefix_pattern(vocabulary)).alias("p")).collect()
    known = set(vocabulary)
    for word, pieces in got:
        at, want = 0, []
        while at < len(word):
            size = max((n for n in range(1, len(word) - at + 1) if word[at:at + n] in known), default=1)
            want.append(word[at:at + size])
            at += size
        assert pieces == want and "".join(pieces) == word
