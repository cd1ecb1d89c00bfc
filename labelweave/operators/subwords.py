"""Sub-words learned from a corpus: merges by distributed pair counts, and the cut
of a word by the longest match over a prefix tree."""

import re
from functools import reduce

from pyspark.sql import functions as F

from labelweave.session import materialise

_OPEN, _SHUT = "\x01", "\x02"  # around a symbol; no word that holds them takes part


def _symbols(state):
    return F.regexp_extract_all(state, F.lit(f"{_OPEN}([^{_SHUT}]*){_SHUT}"), 1)


def spelled(word):
    """A word as its characters, each between marks, so that a merge is a plain
    replacement."""
    return F.regexp_replace(word, "(?s)(.)", f"{_OPEN}$1{_SHUT}")


def pair_counts(states):
    """a, b, n of neighbouring symbols over all words, each as often as it occurs."""
    pairs = F.expr("transform(slice(s, 1, greatest(size(s) - 1, 0)), (x, i) -> struct(x as a, s[i + 1] as b))")
    rows = states.select("n", _symbols("state").alias("s")).select("n", F.explode(pairs).alias("p"))
    return rows.groupBy("p.a", "p.b").agg(F.sum("n").alias("n"))


def best_pairs(counts, limit, min_count):
    """Pairs that come first among all that share a symbol with them, by count,
    then by their symbols: no two of them meet, so one pass can merge them all.
    At most ``limit``, the first of them."""
    rank = F.struct((-F.col("n")).alias("order"), "a", "b")
    ends = counts.where(F.col("n") >= min_count).select("n", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("symbol"))
    first = ends.groupBy("symbol").agg(F.min(rank).alias("first"))
    chosen = first.groupBy("first").agg(F.count("*").alias("ends")).where(
        F.col("ends") == F.when(F.col("first.a") == F.col("first.b"), 1).otherwise(2))
    return chosen.select("first.a", "first.b", (-F.col("first.order")).alias("n")).orderBy(
        F.desc("n"), "a", "b").limit(limit)


def learn_pieces(words, rounds=16, per_round=64, min_count=2, word="word"):
    """The vocabulary learned from a column of words, a list in the order in which
    it was found: all characters first, by code point, then the merges of each round.

    Words are counted once and each distinct word is kept with its symbols. A round
    counts neighbours, merges the pairs of ``best_pairs`` in every word, and ends
    when no pair occurs ``min_count`` times. The driver sees at most ``per_round``
    pairs a round and the characters. Null and empty words are left out.
    """
    marks = F.col(word).rlike(f"[{_OPEN}{_SHUT}]")
    states = materialise(words.where(F.col(word).isNotNull() & (F.col(word) != "") & ~marks).groupBy(F.col(word).alias("w"))
                         .agg(F.count(F.lit(1)).alias("n")).select("n", spelled(F.col("w")).alias("state")), "words")
    single = states.select(F.explode(F.array_distinct(_symbols("state"))).alias("c")).distinct()
    found = sorted(r["c"] for r in single.collect())
    for _ in range(rounds):
        chosen = best_pairs(pair_counts(states), per_round, min_count).collect()
        if not chosen:
            break
        merge = lambda state, p: F.replace(
            state, F.lit(f"{_OPEN}{p['a']}{_SHUT}{_OPEN}{p['b']}{_SHUT}"), F.lit(f"{_OPEN}{p['a']}{p['b']}{_SHUT}"))
        states = materialise(states.select("n", reduce(merge, chosen, F.col("state")).alias("state")), "words")
        found += [p["a"] + p["b"] for p in chosen]
    return list(dict.fromkeys(found))


def prefix_pattern(vocabulary):
    """A regular expression that matches the longest piece at a place: a prefix
    tree, written out, in which a longer way is tried before it ends. A character
    that no piece begins with is matched by itself."""
    tree = {}
    for piece in vocabulary:
        node = tree
        for character in piece:
            node = node.setdefault(character, {})
        if piece:
            node[""] = {}

    def written(node):
        ways = [(re.escape(c) if ord(c) < 128 else c) + written(below) for c, below in sorted(node.items()) if c]
        if not ways:
            return ""
        return f"(?:{'|'.join(ways)})" + ("?" if "" in node else "")
    return "(?s)" + "|".join(filter(None, [written(tree), "."]))


def cut(word, pattern):
    """The pieces of a word in order; joined, they are the word."""
    return F.regexp_extract_all(word, F.lit(pattern), 0)

