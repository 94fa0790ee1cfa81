"""The sink's commit, requests asked once, and calendars of any size."""

import json

import pytest
from pyspark.sql import functions as F

from feedloom.sources import fetch, ics, sink


def test_bytes_of_the_sink(spark, tmp_path):
    rows = [("feeds/a/e.json", f"2026-01-{d:02d}", f"i{k}", json.dumps({"x": f"é\n\"{d}", "n": [], "o": {"p": None}})) for d in range(1, 20) for k in range(3)]
    rows += [("feeds/a/e.json", None, None, None), ("feeds/none/e.json", None, None, None)]
    df = spark.createDataFrame(rows, sink.SCHEMA)
    sink.write(df.repartition(5), f"file://{tmp_path}/t")
    want = json.dumps([json.loads(r[3]) for r in sorted(rows[:-2], key=lambda r: r[1:3])], indent=2, ensure_ascii=True) + "\n"
    assert (tmp_path / "t/feeds/a/e.json").read_text() == want and (tmp_path / "t/feeds/none/e.json").read_text() == "[]\n"
    sink.write(df.filter("id = 'i0'"), str(tmp_path / "t"))  # one path is replaced, the other stays; nothing is left behind
    assert len(json.loads((tmp_path / "t/feeds/a/e.json").read_text())) == 19 and (tmp_path / "t/feeds/none/e.json").exists()
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["feeds"]


def test_a_failed_task_leaves_the_tree(spark, tmp_path):
    good = spark.createDataFrame([(f"f/{k}.json", "1", "1", '{"v": 1}') for k in range(8)], sink.SCHEMA)
    sink.write(good, f"file://{tmp_path}")
    bad = good.withColumn("wire", F.when(F.col("path") == "f/5.json", F.lit("{broken")).otherwise(F.lit('{"v": 2}')))
    with pytest.raises(Exception):  # noqa: B017
        sink.write(bad, f"file://{tmp_path}")
    assert {json.loads(p.read_text())[0]["v"] for p in tmp_path.glob("f/*.json")} == {1} and [p.name for p in tmp_path.iterdir()] == ["f"]


def test_each_request_is_asked_once(spark, tmp_path):
    def counting(url, headers):
        with open(f"{tmp_path}/log", "a") as f:
            f.write(f"{url}|{sorted(headers.items())}\n")
        if "gone" in url:
            return 404, {}, b""
        return (304, {}, b"") if headers.get("If-None-Match") == "e" else (200, {"ETag": "new"}, url.encode())

    rows = [(f"s{i}", f"http://h{i % 3}/{'gone' if i % 5 == 0 else i % 4}", i % 2 == 0, "e", None, None) for i in range(40)] + [("own", "http://h1/1", True, "e", "m", {"If-None-Match": "mine", "X": ""}), ("none", None, True, "e", "m", None)]
    df = spark.createDataFrame(rows, "source string, url string, captured boolean, etag string, last_modified string, headers map<string,string>").repartition(7)
    got = {r.source: r for r in fetch.captures(df, counting, retries=0).collect()}
    log = (tmp_path / "log").read_text().splitlines()
    want = {(r[1], "own" if r[0] == "own" else r[2]) for r in rows if r[1]}
    assert len(log) == len(set(log)) == len(want) and len(got) == len(rows)
    assert got["s5"].outcome == "http_error" and got["s2"].outcome == "not_modified" and got["s1"].body == "http://h1/1" and got["own"].outcome == "ok" and got["none"].outcome == "no_url"
    assert "http://h1/1|[('If-Modified-Since', 'm'), ('If-None-Match', 'mine')]" in log
    hosts = spark.createDataFrame([("HTTP://Ab.c:80/x?y",), ("file:///x",), (None,)], "u string").select(fetch.host(F.col("u")).alias("h"))
    assert [r.h for r in hosts.collect()] == ["ab.c:80", "", ""]


def test_calendars_are_read_in_pieces(spark, tmp_path):
    """The same records and ordinals as of whole texts, whatever the pieces."""
    one = "BEGIN:VEVENT\r\nUID:{0}\r\nSUMMARY:a long\r\n  line of {0}\\, x\r\nDESCRIPTION:BEGIN:VEVENT\r\nX-A;B=\"c:d\":{0}\r\nCATEGORIES:p,q{0}\r\nDTSTART;TZID=Europe/Rome:20260101T100000\r\nEND:VEVENT\r\n"
    for name, n, end in (("big", 3000, "\r\n"), ("unix", 40, "\n"), ("one", 1, "\r\n"), ("empty", 0, "\r\n")):
        body = f"BEGIN:VCALENDAR\r\nPRODID:x\r\n{''.join(one.format(i) for i in range(n))}END:VCALENDAR\r\n"
        (tmp_path / f"{name}.ics").write_text(body.replace("\r\n", end), newline="")
    (tmp_path / "zero.ics").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = ics.scan(spark, f"{tmp_path}/*.ics")
        assert got.rdd.getNumPartitions() > 1
        rows = sorted(got.drop("properties").collect())
        tasks = spark.read.option("lineSep", "\nBEGIN:VEVENT").text(f"{tmp_path}/big.ics").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = spark.read.text(f"{tmp_path}/*.ics", wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.ics$", 1).alias("source"), F.col("value").alias("text"))
    assert tasks > 10 and rows == sorted(ics.records(whole).drop("properties").collect()) and len(rows) == 3041
    assert [r.ordinal for r in rows if r.source == "big"] == list(range(3000))
