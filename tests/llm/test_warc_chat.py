import hashlib

from pyspark.sql import functions as F

from labelweave.llm import chat, warc
from labelweave.session import fresh_dir


def archive(n):
    payloads = [b"<p>%d</p>" % i * (i % 7) for i in range(n)]
    return [warc.warc_member(i, f"http://x/{i}", p, hashlib.sha1(p).hexdigest(), None) for i, p in enumerate(payloads)]


def test_salvage_goes_on_behind_damage():
    members = archive(20)
    data = bytearray(b"".join(members))
    begin = len(b"".join(members[:5]))
    data[begin + len(members[5]) // 2] ^= 0xFF
    found = list(warc.salvage(bytes(data)))
    assert [f[:3] for f in found if f[0] == "gap"] == [("gap", begin, begin + len(members[5]))]
    assert len(found) == 20
    cut = list(warc.salvage(bytes(data[:-3])))
    assert cut[-1][0] == "gap" and "short" in cut[-1][3] and len(cut) == 20


def test_salvage_of_plain_records_and_of_no_archive():
    import gzip
    plain = [gzip.decompress(m) for m in archive(4)]
    broken = plain[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    found = list(warc.salvage(b"junk" + plain[0] + broken + plain[2] + plain[3]))
    assert [f[0] for f in found] == ["gap", "record", "gap", "record", "record"]
    assert list(warc.salvage(b"")) == []
    assert [f[0] for f in warc.salvage(b"nothing of the kind")] == ["gap"]


def test_archives_of_odd_pages(spark):
    rows = [(1, "http://a b\r\n", "same", 0), (2, None, "same", 0), (3, "u", None, 0), (4, "u", "", 0),
            (5, "u", "é" * 10000000, 0), (6, "u", "x", 0), (6, "u", "x", 0), (7, "u", "x", 0), (None, "u", "y", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    folder = fresh_dir(spark, "archives")
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder)
    assert got.where("kind = 'gap'").count() == 0
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["record_id"][10:-1], []).append(r)
    assert {k: [x["type"] for x in v] for k, v in by_id.items()} == {
        "1": ["response"], "2": ["revisit"], "3": ["response"], "4": ["revisit"], "5": ["response"],
        "6": ["response", "response"], "7": ["revisit"], "none": ["response"]}
    assert by_id["5"][0]["payload"] == ("é" * 10000000).encode() and by_id["2"][0]["payload_bytes"] == 4
    empty = fresh_dir(spark, "archives")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_minimum_payload_of_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")],
                                  "page_id long, url string, html string")
    folder = fresh_dir(spark, "archives")
    warc.write_archives(pages, folder, min_bytes=3)
    kinds = {r["record_id"]: r["type"] for r in warc.read_archives(spark, folder).collect()}
    assert [kinds[f"<urn:page:{i}>"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]


def test_preferences_of_odd_pairs(spark):
    turn = lambda *t: [{"role": r, "text": x} for r, x in t]
    a = turn(("user", "hi"), ("assistant", "yes"), ("user", "so"))
    b = turn(("user", "hi"), ("assistant", "no <|end|>"))
    rows = [(1, a, b, 7), (2, a, a, 7), (3, None, b, 7), (4, [], None, 7), (5, turn((None, None)), turn((None, None)), 7),
            (6, a[:1], b, 7)]
    pairs = spark.createDataFrame(rows, "pair_id int, chosen array<struct<role:string,text:string>>, "
                                        "rejected array<struct<role:string,text:string>>, prompt int")
    got = {r["pair_id"]: r for r in chat.format_preferences(pairs).collect()}
    assert got[1]["prompt"] == "<|user|>\nhi<|end|>\n"
    assert got[1]["rejected"] == "<|assistant|>\nno < |end|><|end|>\n"
    assert got[1]["chosen_mask"] == "0" * 14 + "1" * 11 + "0" * 9 + "0" * 10
    assert [got[i]["prompt_turns"] for i in range(1, 7)] == [1, 3, 0, 0, 1, 1]
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[6]["chosen"] == ""
    for r in got.values():
        assert len(r["chosen"]) == len(r["chosen_mask"]) and len(r["rejected"]) == len(r["rejected_mask"])


def test_pairs_of_odd_conversations(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "r0"), (1, 0, "user", "p"), (1, 0, "user", "p"),
            (1, 1, "assistant", None), (2, None, None, None), (3, 0, "assistant", "z"), (None, 0, "user", "lost")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.format_preferences(chat.swapped_reply_pairs(turns)).collect()}
    assert set(got) == {0, 1, 3} and got[1]["prompt_turns"] == 2
    assert got[0]["rejected"] == "<|assistant|>\n<|end|>\n" and got[3]["rejected"] == "<|assistant|>\nr0<|end|>\n"
    even = turns.where("conv_id is not null").withColumn("conv_id", F.col("conv_id") * 2)
    assert {r["pair_id"] for r in chat.swapped_reply_pairs(even).collect()} == {0, 2, 6}
    alone = chat.swapped_reply_pairs(turns.where("conv_id = 3")).collect()
    assert [r["chosen"] == r["rejected"] for r in alone] == [True]
    assert chat.swapped_reply_pairs(turns.limit(0)).count() == 0
