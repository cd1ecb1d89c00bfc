"""Records over several lines, headers of many layouts, and uploads in isolation."""

import csv
import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from labelweave.config import Augmentation
from labelweave.sources import address_files as af
from labelweave.sources import csv_records as cr
from labelweave.streaming import ingest


def put(root, files):
    for name, content in files.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as out:
            out.write(content if isinstance(content, bytes) else content.encode())
    return str(root)


def plain(text, sep=","):
    """Values as the standard reader gives them, blanks before a value left out."""
    return [row for row in csv.reader(io.StringIO(text.replace("\r\n", "\n")), delimiter=sep, skipinitialspace=True) if row]


RECORDS = ['a,b,c', '"a,1","b ""q""",c', 'x,"two\nlines",y', '"\n\n",,', 'st"ray,"b"tail,"', 'p,"q\nr","s\nt"', ',,', '"only"',
           '1, "lead",3', '"open ""and"" shut",z', 'é,"日\n本",ß', '"a","b\n"",""\nc",d', '""', '"","","\n"']


@pytest.mark.parametrize("sep", [",", "\t", ";", "|"])
def test_values_of_a_record(spark, sep):
    records = [r.replace(",", sep) for r in RECORDS if not r.endswith(',"')]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string")
    got = {r["i"]: r["v"] for r in df.select("i", cr.split_record(F.col("r"), sep).alias("v")).collect()}
    assert [got[i] for i in range(len(records))] == [plain(r, sep)[0] for r in records]


@pytest.mark.parametrize("split_bytes", [None, "64", "7"])
@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_records_over_lines_and_splits_equal_a_single_reader(spark, tmp_path, split_bytes, ends):
    rng = random.Random(11)
    usable = [r for r in RECORDS if r not in ('st"ray,"b"tail,"',)] + ['st"ray,b"c', "12345", "no quotes, at all"]
    texts = {f"d/f{i}.csv": ends.join(rng.choices(usable, k=rng.randrange(1, 60))) + (ends if i % 2 else "") for i in range(6)}
    texts["d/clean.csv"] = ends.join("abcdefgh"[:rng.randrange(1, 8)] for _ in range(80))
    texts["d/long.csv"] = 'k,"' + ends.join(f"line {i}" for i in range(70)) + f'",end{ends}after,"x"'
    root = put(tmp_path, texts)
    # Also within quotes a line end is read as \n.
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = cr.csv_records(spark, root).where("record <> ''").withColumn("v", cr.split_record(F.col("record"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for r in sorted(rows, key=lambda r: (r["start"], r["at"])):
        got.setdefault(r["file"].rsplit("/", 1)[-1], []).append(r["v"])
    assert got == {name.rsplit("/", 1)[-1]: plain(text) for name, text in texts.items()}
    assert all(r["whole"] for r in rows)


def test_a_quote_left_open_takes_the_rest_and_is_not_whole(spark, tmp_path):
    root = put(tmp_path, {"a.csv": 'A,B\n1,2\n3,"open\n4,5\n', "b.csv": "A\n7\n"})
    rows = {(r["file"][-5:], r["record"], r["whole"]) for r in cr.csv_records(spark, root).collect()}
    assert rows == {("a.csv", "A,B", True), ("a.csv", "1,2", True), ("a.csv", '3,"open\n4,5', False),
                    ("b.csv", "A", True), ("b.csv", "7", True)}


def test_headers_are_records(spark, tmp_path):
    root = put(tmp_path, {
        "quoted.csv": '"STREET, full",NUMBER,"CI\nTY",City\n"Main, St.",5,x,Rome\n',
        "double.csv": "NUMBER,number,Street\n,7,Wall\n8,9,Low\n",
        "blank.csv": "\n\n  \nNUMBER,CITY\n3,Oslo\n",
        "bom.csv": "﻿NUMBER,CITY\r\n4,Bern\r\n",
        "unknown.csv": "foo,bar\n1,2\n", "headonly.csv": "NUMBER,STREET", "empty.csv": "",
        "short.csv": "NUMBER,STREET,CITY\n5\n6,Six,Y,beyond\n"})
    rows = af.read_by_header(spark, [root])
    got = {}
    for r in rows.collect():
        got.setdefault(r["path"].rsplit("/", 1)[-1], []).append((r["house_number"], r["road"], r["city"]))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        "quoted.csv": [("5", None, "Rome")], "double.csv": [("7", "Wall", None), ("8", "Low", None)],
        "blank.csv": [("3", None, "Oslo")], "bom.csv": [("4", None, "Bern")], "unknown.csv": [(None, None, None)],
        "short.csv": [("5", None, None), ("6", "Six", "Y")]}
    with pytest.raises(ValueError):
        af.read_by_header(spark, [put(tmp_path / "none", {"x.csv": ""})])


def test_many_layouts_are_one_scan(spark, tmp_path):
    names = ["NUMBER", "STREET", "CITY", "POSTCODE", "UNIT", "STATE"]
    rng, files, want = random.Random(1), {}, set()
    for i in range(300):
        order = rng.sample(names, 6) + [f"extra{i}"]
        files[f"{i}.csv"] = ",".join(order) + "\n" + ",".join(f"{n}{i}" for n in order) + "\n"
        want.add(tuple(f"{n}{i}" for n in names))
    rows = af.read_by_header(spark, [put(tmp_path, files)], keep_path=False)
    assert {(r.house_number, r.road, r.city, r.postcode, r.unit, r.state) for r in rows.collect()} == want
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 2


def test_tree_records_equal_the_tree_and_keep_line_ends(spark, tmp_path):
    header = "LON,LAT,NUMBER,STREET,UNIT,CITY,DISTRICT,REGION,POSTCODE,ID,HASH"
    root = put(tmp_path, {"x/a.csv": f"{header}\n1,2,3,Main St.,,,,,9\n4,5,6,\"Low, Rd\",u\n", "b.csv": f"{header}\n"})
    some = lambda df: sorted(map(str, df.collect()))
    assert some(af.read_tree_records(spark, root)) == some(af.read_tree(spark, root))
    put(tmp_path, {"x/c.csv": f'{header}\n1,2,3,"two\nlines",,,,,9\n'})
    assert [r["road"] for r in af.read_tree_records(spark, root).where("path like '%c.csv'").collect()] == ["two\nlines"]


def test_bad_uploads_are_named_and_keep_nothing_from_the_others(spark, tmp_path):
    broken = gzip.compress(b"NUMBER,STREET\n1,Gone\n" * 5000)[:-40]
    root = put(tmp_path / "up", {
        "good.csv": "NUMBER,STREET\n5,Wall\n", "twice.csv": "NUMBER,NUMBER,STREET\n6,7,Low\n",
        "blank.csv": "\nNUMBER,STREET\n8,High\n", "empty.csv": "\n  \n", "none.csv": "foo\n1\n",
        "open.csv": 'NUMBER,STREET\n9,Mill\n1,"never\n2,shut\n', "beyond.csv": "NUMBER,STREET\n3,Park,,x\n4,East,,\n",
        "a inputdict.txt": '[{"components": {"road": "Main", "city": "Rome"}}]\nnot json\n\n', "b.gz.csv": "NUMBER\n1\n",
        "other.txt": "ignored\n"})
    put(tmp_path / "up", {"bad.csv.gz.csv": b"NUMBER,STREET\n2,Fine\n"})
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    settings = {"sink": "parquet", "augmentation": Augmentation(), "max_files": 4}
    ingest.run_ingest(spark, root, out, state, **settings)
    texts = lambda: sorted(r["text"] for r in spark.read.parquet(out).collect())
    want = ["1", "2 Fine", "4 East", "5 Wall", "6 Low", "8 High", "9 Mill", "Main Rome"]
    assert texts() == want

    def problems():
        rows = spark.read.json(f"{out}_quarantine").collect()
        return {(r["path"].rsplit("/", 1)[-1], r["reason"], r["lines"]) for r in rows}
    assert problems() == {("empty.csv", "no header", 0), ("none.csv", "no column of a known name", 1),
                          ("open.csv", "a quote is open where the file ends", 1), ("beyond.csv", "more values than names", 1),
                          ("a inputdict.txt", "no geocoder result", 1)}
    # A file that cannot be read at all is named, the others of its batch are written.
    put(tmp_path / "up", {"cut inputdict.txt": '[{"components": {"road": "Side"}}]\n', "late.csv": "CITY\nParis\n"})
    put(tmp_path / "up", {"torn.csv": "CITY\nx\n"})
    whole, real = [], ingest.uploads_of

    def fails(session, paths, json_files):
        if any("torn" in p for p in paths):
            whole.append(len(paths))
            session.read.parquet(f"{out}/nowhere").count()
        return real(session, paths, json_files)
    seen = ingest.unreadable
    ingest.uploads_of, ingest.unreadable = fails, lambda s, p: "torn apart" if "torn" in p else seen(s, p)
    try:
        ingest.run_ingest(spark, root, out, state, **settings)
    finally:
        ingest.uploads_of, ingest.unreadable = real, seen
    assert texts() == sorted([*want, "Side", "Paris"]) and whole == [3]
    assert ("torn.csv", "torn apart", 0) in problems()
    torn = put(tmp_path / "gz", {"x.csv.gz": broken})
    assert ingest.unreadable(spark, f"{torn}/x.csv.gz") and not ingest.unreadable(spark, f"{root}/late.csv")
    ingest.run_ingest(spark, root, out, state, **settings)
    assert texts() == sorted([*want, "Side", "Paris"])
