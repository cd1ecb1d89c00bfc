"""Vector codes and the conversation trie against plain computations."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from labelweave.llm import turn_trie, vector_codes


@pytest.mark.parametrize("top", [3, 1 << 12, 1 << 24, 1 << 28])
def test_limb_products_are_exact(top):
    rng = np.random.default_rng(7)
    a, b = (rng.integers(-top, top, (40, 16)) for _ in range(2))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
    assert vector_codes.exact_products(a, b).tolist() == want
    for values in (a, b):
        bits = vector_codes.limb_bits(16)
        parts = vector_codes.limbs(values, bits)
        assert (sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(parts)) == values).all()


def test_nearest_takes_the_first_of_equals_and_reckons_large_integers():
    entries = np.array([[5, 5], [0, 0], [0, 0], [2, 0]])
    at, far = vector_codes.nearest(np.array([[0, 0], [1, 0], [9, 9]]), entries)
    assert at.tolist() == [1, 1, 0] and far.tolist() == [0, 1, 32]
    big = 1 << 40
    at, far = vector_codes.nearest(np.array([[big, -big]]), np.array([[0, 0], [big, big]]))
    assert at.tolist() == [0] and far.tolist() == [2 * big * big]


def plain_codes(rows, rounds=4):
    rows = [(i, label, [vector_codes._floor(x) for x in v]) for i, label, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(first[0][2]) // 4
    cut = lambda v: [tuple(v[p * width:(p + 1) * width]) for p in range(4)]
    books = [[cut(v)[p] for _, _, v in first[:256]] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda part, p: min(range(len(books[p])), key=lambda e: (far(part, books[p][e]), e))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, _, v in rows:
            for p, part in enumerate(cut(v)):
                members[p, best(part, p)].append(part)
        for (p, e), parts in members.items():
            books[p][e] = tuple(sum(c) // len(parts) for c in zip(*parts))
    out = []
    for i, label, v in rows:
        chosen = [best(part, p) for p, part in enumerate(cut(v))]
        error = sum(far(part, books[p][e]) for (p, part), e in zip(enumerate(cut(v)), chosen))
        out.append((i, label, "".join(f"{e:02x}" for e in chosen), error))
    total = defaultdict(int)
    for _, label, _, error in out:
        total[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, total[label], digest) for i, label, c, e in out), key=str)


def coded(spark, rows, schema="vec_id long, embedding array<double>, label int, code string"):
    df = spark.createDataFrame([(i, v, label, "x") for i, label, v in rows], schema)
    got = vector_codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


def test_vector_codes_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(i) % 3 if i % 5 else None, (rng.normal(size=8) * 3).tolist()) for i in rng.permutation(300)]
    rows += [(1000, 1, None), (1001, 1, [None] * 8), (1002, 1, [float("nan")] * 8), (1003, 1, [float("inf")] * 8)]
    rows += [(5, 1, [0.5] * 8), (5, 1, [0.5] * 8), (None, 2, [0.25] * 8), (1004, 2, [-0.0001] * 8)]
    assert coded(spark, rows) == plain_codes(rows)
    large = [(i, 0, [float(x) for x in rng.integers(-(1 << 40), 1 << 40, 8)]) for i in range(9)]
    large += [(i, 0, [1e-3 * i] * 8) for i in range(20, 40)]
    got, want = coded(spark, large), plain_codes(large)
    fits = lambda e: e if e < 1 << 63 else None
    assert [(r[0], r[1], r[2]) for r in got] == [(r[0], r[1], fits(r[2])) for r in want]
    assert coded(spark, []) == []
    other = coded(spark, [(0, 1, [1.0] * 8), (1, 1, [1.0] * 4), (2, 1, [])])
    assert [(r[0], r[1], r[2], r[3]) for r in other] == [(0, "00000000", 0, 0), (1, None, None, 0), (2, None, None, 0)]
    assert [r[1:4] for r in coded(spark, [(0, 1, []), (1, 1, [])])] == [("00000000", 0, 0)] * 2


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    member = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            member[tuple(path[:d])].append(c)
    out = []
    for path, convs in member.items():
        d = len(path)
        below = [p for p in member if p[:d] == path]
        children = [p for p in below if len(p) == d + 1]
        leaf = lambda p: not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(whole[c]) == d))
        out.append((min(convs), d, min(member[path[:-1]]) if d else None, len(convs), len(children),
                    sum(leaf(p) for p in below),
                    sum((len(member[p]) - 1) * len(p[-1][1].split()) for p in below if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


ODD_TALKS = (
    [(c, t, "user" if t % 2 else "assistant", f"same words {t}") for c in range(0, 90, 3) for t in range(c % 7)]
    + [(c, t, "user", f"own {c if t > 4 else 0} {t}") for c in range(200, 230) for t in range(9)]
    + [(40, 3, None, None), (40, None, "user", "null turn first"), (41, 1, "user", ""), (41, 1, "user", "tie"),
       (41, 1, "user", "tie"), (None, 1, "user", "no conversation"), (1000, 1, "user", "one"), (1007, 0, "a", "word " * 5000)]
    + [(5000, t, "user", f"long {t % 2}") for t in range(60)] + [(5001, t, "user", f"long {t % 2}") for t in range(47)])


@pytest.mark.parametrize("block, segment", [(1024, 256), (3, 5), (1, 1)])
def test_trie_of_odd_conversations(spark, monkeypatch, block, segment):
    monkeypatch.setattr(turn_trie, "BLOCK_CONVERSATIONS", block)
    monkeypatch.setattr(turn_trie, "SEGMENT_TURNS", segment)
    df = spark.createDataFrame([(*r, 7) for r in ODD_TALKS],
                               "conv_id long, turn long, role string, text string, depth int")
    assert sorted((tuple(r) for r in turn_trie.prefix_trie(df).collect()), key=str) == plain_trie(ODD_TALKS)
    assert turn_trie.prefix_trie(df.limit(0)).count() == 0
