"""Archives: exact round trips, references, and the merged index against a sort."""

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strata.llm import common, warc
from tests.llm.data import with_clashes

DDL = "page_id long, url string, html string, capture_time timestamp"
T0 = datetime.datetime(2021, 5, 4, 3, 2, 1)


def pages():
    big, other = "<p>é中🙂</p>" * 200, "y" * 1000
    tricky = "WARC/1.1\r\nWARC-Type: response\r\n\r\nx\r\n\r\nWARC/1.1\r\n" + "t" * 1000
    rows = [(1, "http://www.A.example.com:80/x?q=1#f", big), (2, "https://a.example.com/x", big),
            (9, "http://b.example.org", big), (3, "http://b.example.org", other), (4, None, other + "z"),
            (5, "http://u@c.example/a\r\nb: c", None), (6, "", ""), (7, "x", "short"), (8, "x", "short"),
            (10, "x", tricky), (11, "y", tricky), (12, "http://c.example/", "\r\n\r\n" * 300),
            (None, "n", big), (None, "n", "q" * 1500), (None, "m", "q" * 1500), (13, "x", "s" * 999), (14, "x", "s" * 999),
            (20, "z", "twice" * 300), (20, "z", "twice" * 300), (15, None, None), (16, "x", "k" * 300_000)]
    rows += [(100 + i, "http://hot.example/", "hot" * 400) for i in range(40)]
    return [(*r, None if r[0] == 7 else T0 + datetime.timedelta(seconds=(r[0] or 0) % 5)) for r in rows]


def wanted(rows, least=1000):
    last = {}
    for i, _, html, _ in rows:
        if i is not None and len((html or "").encode()) >= least:
            last[html] = max(i, last.get(html, i))
    out = []
    for i, url, html, _ in rows:
        data = (html or "").encode()
        to = last.get(html) if len(data) >= least else None
        again = to is not None and to != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()], key=str)


def frame(spark, parts=3):
    return with_clashes(spark.createDataFrame(pages(), DDL)).repartition(parts)


@pytest.mark.parametrize("archive_bytes,range_rows", [(64_000_000, 100_000), (3000, 10)])
def test_round_trip_and_order(spark, scratch, archive_bytes, range_rows):
    index = warc.archive_pages(frame(spark), path=scratch, archive_bytes=archive_bytes, range_rows=range_rows)
    assert found(index) == wanted(pages())
    rows = index.orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    keys = [(r["url_key"].encode(), r["capture_time"], r["page_id"] is None, r["page_id"] or 0) for r in rows]
    assert keys == sorted(keys)
    assert {r["url"] for r in rows if r["page_id"] == 5} == {"http://u@c.example/a%0D%0Ab: c"}


def test_records_are_whole(spark, scratch):
    """Offsets and lengths of the index cut exact records out of the files."""
    index = warc.archive_pages(frame(spark), path=scratch, archive_bytes=5000).collect()
    files = {r["path"]: bytes(r["content"]) for r in spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter="part-*").load(scratch).collect()}
    html = {r[0]: (r[2] or "").encode() for r in pages()}
    for r in index:
        (at, length, headers, block), = warc.parse(files[r["archive"]][r["offset"]:r["offset"] + r["length"]])
        assert (at, length) == (0, r["length"]) and headers["warc-type"] == r["record_type"]
        payload = block.split(b"\r\n\r\n", 1)[1]
        if r["page_id"] is not None:
            assert payload == (html[r["page_id"]] if r["record_type"] == "response" else b"")
        if r["refers_to"] is not None:
            assert hashlib.sha1(html[r["refers_to"]]).hexdigest() == r["payload_digest"]
    assert sum(map(len, files.values())) == sum(r["length"] for r in index)
    assert len(files) > 10


def test_groups_too_many_to_broadcast(spark, monkeypatch, scratch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "HEAVY", 10)
    assert found(warc.archive_pages(frame(spark), path=scratch)) == wanted(pages())


def test_empty_table(spark, scratch):
    index = warc.archive_pages(spark.createDataFrame([], DDL), path=scratch)
    assert index.count() == 0 and index.columns[-1] == "position"


def test_damaged_archives_fail():
    good = warc.record(1, "u", "2020-01-01T00:00:00.000000Z", b"abc", None) + warc.END
    assert len(list(warc.parse(good))) == 1
    for bad in (good[:-1], good[3:], good.replace(b"Content-Length: 7", b"Content-Length: 8") + b"x"):
        with pytest.raises(ValueError):
            list(warc.parse(bad))
    (at, n, headers, block), = warc.parse(good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))
    with pytest.raises(ValueError):
        warc.capture(headers, block, "f", at, n)


@pytest.mark.parametrize("url,key", [
    ("http://www.Example.com:80/a?b", "com,example)/a?b"), ("https://user:pw@sub.example.org", "org,example,sub)/"),
    ("example.org?x", "org,example)?x"), ("ftp://h:8080/", "h:8080)/"), (None, ""), ("", ""), ("///", ")///")])
def test_url_key(url, key):
    assert warc.url_key(url) == key


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16, 33])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted((rng.randint(0, 9), i) for i in range(rng.randint(0, 20))) for _ in range(k)]
    merged = list(warc.LoserTree(runs, lambda x: x))
    assert merged == sorted(sum(runs, []))


def test_one_run_in_blocks(spark, scratch):
    """Rows of a run that reach the merge in another order."""
    warc.write_archives(frame(spark, 1), scratch)
    runs = common.store(warc.capture_runs(spark, scratch), "test-runs")
    mixed = common.store(runs.orderBy(F.xxhash64("seq")).coalesce(1), "test-mixed")
    assert found(warc.merged_index(mixed)) == wanted(pages())
