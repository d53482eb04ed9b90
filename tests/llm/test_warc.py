import base64
import hashlib
import io
import re

import pytest

from dimweave.llm import warc
from dimweave.llm.queries import QUERIES

from .conftest import SF

ODD = [
    (1, "http://a", "x"),
    (2, None, "x"),
    (3, "u\r\nX: é %41 ", "x"),
    (4, "u", None),
    (5, "", ""),
    (None, "u", "q"),
    (None, None, "x"),
    (7, "u", "\r\n\r\nWARC/1.1"),
    (7, "u", "7"),
    (7, "u", "7"),
    (8, "b", "7"),
    (9, "long", "é" * 300000),
] + [(100 + i, "h", "hot") for i in range(50)]


def by_definition(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p in groups[raw] if p is not None]
        keeper = max(ids, default=None)
        revisit = len(groups[raw]) > 1 and keeper is not None and page != keeper
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ODD, "page_id long, url string, html string")


@pytest.fixture(scope="module")
def archive(pages):
    return warc.write_archives(pages)


def test_query_equals_definition(spark):
    got = sorted((tuple(r) for r in QUERIES["op6_warc"](spark, SF).collect()), key=str)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got == by_definition(rows)


def test_odd_pages(spark, archive):
    records = warc.read_archives(spark, archive).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str)
    assert got == by_definition(ODD)
    assert sorted((str(r.page_id), str(r.url)) for r in records) == sorted((str(p), str(u)) for p, u, _ in ODD)
    payloads = {(p, (h or "").encode()) for p, _, h in ODD}
    assert all((r.page_id, bytes(r.payload)) in payloads for r in records if r.record_type == "response")
    assert all(r.payload is None for r in records if r.record_type == "revisit")


def test_every_group_hot_or_none(spark, pages):
    """Both ways of finding the response give the same records."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "1000"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            rows = warc.archive_rows(pages).select("page_id", "record_type", "refers_to").collect()
            want = sorted(((x[0], x[3], x[4]) for x in by_definition(ODD)), key=str)
            assert sorted(map(tuple, rows), key=str) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_filters_are_pushed_down(spark, archive):
    found = warc.read_archives(spark, archive).filter("record_type = 'revisit' and page_id in (1, 2, 100)")
    assert sorted(r.page_id for r in found.collect()) == [1, 2, 100]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.split("\n") if re.match(r"[\s:+*()\d-]*Filter ", line)]
    # Spark checks for null itself; what compares values is left to the source
    assert filters and all("revisit" not in line and " IN " not in line for line in filters)
    assert warc.read_archives(spark, archive, payloads=False).filter("payload is not null").count() == 0


def test_skipped_blocks_are_not_read(spark):
    rows = [{"page_id": k, "url": None, "payload": b"p" * 1000, "record_type": "response", "refers_to": None} for k in range(3)]
    raw = b"".join(warc.record(r, "1970-01-01T00:00:00Z") for r in rows)
    broken = raw.replace(b"\x1f\x8b", b"\0\0", 1)  # the first payload can't be decoded
    found = list(warc.read_records(io.BytesIO(broken), lambda h: "page:0" not in h["warc-record-id"]))
    assert [p for _, p in found] == [b"p" * 1000] * 2
    with pytest.raises(Exception):
        list(warc.read_records(io.BytesIO(broken)))


def test_empty_table(spark, pages):
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0
