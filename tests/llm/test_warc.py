"""WARC: round trips, and ranges of every size give each record once."""

import base64
import gzip
import hashlib
import random
import zlib

import pyarrow as pa

from gristmill.llm import warc
from gristmill.llm.common import shared_dir

PAGES = "page_id long, url string, html string"


def test_round_trip(spark):
    rng = random.Random(0)
    rows = [(i, f"http://h/{i}\r\nX: y", rng.choice(["", "<p>é😀</p>", "WARC/1.0\r\n\r\nx", "a" * 5000, str(i)])) for i in range(120)]
    rows += [(None, None, None), (500, None, "only"), (7, "http://again", "only"), (500, None, "only")]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        top = largest[h or ""]
        kind = ("response", None) if i == top else ("revisit", top)
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *kind))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_are_responses(spark):
    got = warc.round_trip(spark.createDataFrame([(1, "u", "x"), (2, "v", "x")], PAGES), least_bytes=2).collect()
    assert {r.record_type for r in got} == {"response"}


def test_ranges_own_each_record_once():
    inner = gzip.compress(b"no WARC header")  # gzip magic in a stored payload is no record
    noise = random.Random(1).randbytes(3000)
    members = []
    for i in range(40):
        block = inner + noise[: i * 70]
        c = zlib.compressobj(0, zlib.DEFLATED, 31)
        members.append(c.compress(b"WARC/1.0\r\nWARC-Page-Id: %d\r\n\r\n" % i + block) + c.flush())
    data = b"".join(members)
    for step in (1, 7, 100, 1000, 10**6):
        found = [r for s in range(0, len(data), step) for r in warc.records(pa.BufferReader(data), s, min(s + step, len(data)))]
        assert [int(r.split(b"Page-Id: ")[1].split(b"\r")[0]) for r in found] == list(range(40))


def test_payloads_come_back(spark):
    df = spark.createDataFrame([(i, f"u{i}", f"<b>{i}</b>" * 99) for i in range(30)], PAGES)
    back = warc.read(warc.write(df, shared_dir(spark, "t")), range_bytes=64)
    assert {(r.page_id, r.html) for r in back.collect()} == {(r.page_id, r.html) for r in df.collect()}
