"""WARC archives (12): round trips against SQL, payloads that imitate records, splits of any size."""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillscope.llm import warc
from tillscope.session import scratch_path

INSIDE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99:x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
HTML = ["x WARC/1.1\r\nbla", INSIDE, "", None, "aä" * 3000 + "WARC/1.1\r\n" * 3, "dup", "dup", "dup", "\r\n\r\n", "q\r\n\r\n" + INSIDE[:-4] + "tail",
        INSIDE * 3, "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n", "WARC/1.1\r\nContent-Length: 1000000\r\n\r\n" + "z" * 300]
ROWS = [(i, None if i % 4 == 0 else f"http://a/{i % 3}", h) for i, h in enumerate(HTML)] + [
    (7, "http://a/1", "dup"), (7, "http://a/1", "dup"), (6, "http://a/0", "dup"), (6, "http://a/0", "dup"), (None, None, "dup"), (None, "u", "solo"),
    (5, "é\r\nx", "long " * 20000), (70, "b", INSIDE), (71, "b", INSIDE)]


def expected(rows, least=0):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) by hand."""
    groups = defaultdict(list)
    for i, u, h in rows:
        groups[(h or "").encode()].append((i is not None, i, u or ""))
    out = []
    for payload, members in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2]), reverse=True)
        for k, (_, i, _) in enumerate(members):
            again = k > 0 and len(payload) >= least
            out.append((i, len(payload), digest, "revisit" if again else "response", members[0][1] if again else None))
    return sorted(out, key=str)


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "f", "s", "k") for r in rows], "page_id long, url string, html string, file string, start string, key string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("split,least", [("64m", 0), ("700", 4)])
def test_round_trip(spark, split, least):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert rows_of(warc.archive_round_trip(pages(spark).repartition(2), least)) == expected(ROWS, least)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_hot_payload_and_many_copies(spark):
    rows = [(i, "u", "same") for i in range(300)] + [(299, "u", "same")] * 300 + [(1000 + i, None, f"own {i}") for i in range(20)]
    assert rows_of(warc.archive_round_trip(pages(spark, rows).repartition(5))) == expected(rows)


def test_empty(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_fields_and_urls(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages(spark), path)
    got = {r.page_id: r.url for r in warc.read_archives(spark, path).collect()}
    assert got[1] == "http://a/1" and got[4] is None and got[5] == "é%0D%0Ax"
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert text.startswith("WARC/1.1\r\nWARC-Type: ") and text.endswith("\r\n\r\n")


def test_damage_ends_the_chain(spark):
    """A record cut short is no record; what stands before it stays, what stands behind it cannot be told from a payload."""
    path = scratch_path(spark, "warc-cut")
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{}:k>\r\nContent-Length: {}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\n\r\n"
    good = [head.format(i, len(http) + 3) + http + "abc" for i in (1, 2)]
    bad = head.format(3, len(http) + 50) + http + "abc"
    spark.createDataFrame([("\r\n\r\n".join([*good, bad, good[0]]),)], "v string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert [r.page_id for r in warc.read_archives(spark, path).orderBy("page_id").collect()] == [1, 2]


def test_pointer_jumping(spark):
    links = [("f", 0, 5), ("f", 3, 9), ("f", 5, 9), ("f", 9, 12), ("f", 12, 20), ("g", 1, 5), ("g", 5, None), ("h", 0, 7), ("h", 4, 7)]
    got = warc.reached(spark.createDataFrame(links, "file string, a long, b long")).orderBy("file", "a").collect()
    assert [tuple(r) for r in got] == [("f", 0), ("f", 5), ("f", 9), ("f", 12), ("h", 0)]


def test_base32(spark):
    for text in ("", "a", "ä" * 99):
        got = spark.range(1).select(warc.base32_sha1(F.lit(text))).first()[0]
        assert got == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
