import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelweave.llm import byte_bpe, packing, token_counts

PARTS = ["a", "b", "don't", "'re", "'", "'l", "l", " ", "  ", "\n", "\t", "<|endoftext|>", "<|end", "é", "ß", "日本",
         "23", "!!", ".", "the", "ing", "\x85", "\x1c", "😀", "ա՘", " <|", "|>", "tion", "\r\n", "'ve", "''"]


def test_every_prefix_has_the_count_of_the_library():
    bpe = byte_bpe.load()
    draw = random.Random(5)
    for _ in range(300):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14)))
        counts = [0, *np.frombuffer(bpe.text_steps(text), np.int8).cumsum().tolist()]
        want = [len(bpe.library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counts == want, text
        assert bpe.text_ids(text).tolist() == bpe.library.encode(text, add_special_tokens=False).ids


def test_counts_of_the_table(run_query, read):
    bpe = byte_bpe.load()
    got = run_query("op1_token_counts").set_index("doc_id")
    for doc_id, text in read("documents")[["doc_id", "text"]].itertuples(index=False):
        row = got.loc[doc_id]
        n = len(bpe.library.encode(text or "", add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (n, len((text or "").encode()), n > 512)


def test_prefix_questions_and_odd_rows(odd_documents):
    bpe = byte_bpe.load()
    rows = token_counts.with_prefix_counts(odd_documents).select(
        "doc_id", "text", "size", "n_tokens", token_counts.count_of_prefix("prefix_steps", F.lit(5)).alias("five"),
        token_counts.chars_within("prefix_steps", F.lit(3)).alias("three")).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        n = lambda t: len(bpe.library.encode(t, add_special_tokens=False).ids)
        text = r["text"] or ""
        assert r["n_tokens"] == n(text) and r["five"] == n(text[:5])
        if len(text) < 100:
            assert r["three"] == max(k for k in range(len(text) + 1) if n(text[:k]) <= 3)


def optimum(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {size: k for k, size in enumerate(bins) if size + items[i] <= capacity}.values():
            bins[b] += items[i]
            place(i + 1, bins)
            bins[b] -= items[i]
        place(i + 1, [*bins, items[i]])
    items = sorted(items, reverse=True)
    place(0, [])
    return best[0]


def test_dominance_keeps_the_optimum():
    draw = random.Random(3)
    for _ in range(150):
        items = [draw.randint(1, 20) for _ in range(draw.randint(0, 10))]
        count = {w: items.count(w) for w in items}
        left = dict(count)
        fixed = packing.reduce_by_dominance(left, 20)
        rest = [w for w, n in left.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + optimum(rest, 20) == optimum(items, 20)
        plan = packing.plan_sequences(count, 20)
        assert all(sum(w * k for w, k in p) <= 20 for _, p in plan)
        packed = {}
        for n, pattern in plan:
            for w, k in pattern:
                packed[w] = packed.get(w, 0) + n * k
        assert packed == count


def check_packing(rows, texts):
    bpe = byte_bpe.load()
    whole = sorted(tuple([*bpe.library.encode(t or "", add_special_tokens=False).ids, 2]) for t in texts)
    crcs = sorted(zlib.crc32(np.array(ids[max(0, len(ids) - 1024 * (k + 1)):len(ids) - 1024 * k], "<u4").tobytes())
                  for ids in whole for k in range(-(-len(ids) // 1024)))
    assert sorted(rows.ids_crc32) == crcs
    assert rows.length.sum() == sum(map(len, whole))
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        ends = sequence.offset + sequence.length
        assert sequence.offset.iloc[0] == 0 and ends.iloc[-1] <= 1024
        assert (ends.iloc[:-1].to_numpy() == sequence.offset.iloc[1:].to_numpy()).all()
    return rows.sequence_id.nunique() - -(-rows.length.sum() // 1024)


def test_packing_of_the_table(run_query, read):
    rows = run_query("op4_best_fit_packing")
    assert check_packing(rows, read("documents").text) <= 3
    for _, pieces in rows.sort_values("piece").groupby("doc_id"):
        assert pieces.piece.tolist() == list(range(len(pieces)))
        assert (pieces.start + pieces.length).tolist()[:-1] == pieces.start.tolist()[1:]
        assert (pieces.length.iloc[1:] == 1024).all()


def test_packing_of_odd_and_no_rows(odd_documents):
    check_packing(packing.pack_documents(odd_documents).toPandas(), [r["text"] for r in odd_documents.collect()])
    assert packing.pack_documents(odd_documents.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.plan_sequences({2000: 1})


def test_sequences_hold_the_ids(spark, odd_documents):
    from labelweave.session import materialise
    pieces = materialise(packing.document_pieces(odd_documents, with_ids=True), "pieces")
    made = packing.sequences(packing.pack(pieces)).collect()
    assert sum(len(r["ids"]) for r in made) == 4 * pieces.agg(F.sum("length")).first()[0]
