"""Archives: round trips, revisits, and damage that must be noticed."""

import gzip
import hashlib
import io

import pytest

from suite import check
from tablesync.llm import queries, warc
from tests.llm.helpers import prose

LONG = "<p>" + prose(4, 400) + "</p>"
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://a/4\r\nX: y", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
    (8, "üé", "é" * 700), (9, "u", "\r\n\r\n" * 300), (9, "u", "\r\n\r\n" * 300), (None, "u", LONG), (None, None, None), (10, "u", prose(5, 60_000)),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, largest long")


def expected(rows):
    largest = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page_id is not None:
            largest[data] = max(largest.get(data, page_id), page_id)
    for page_id, _, html in rows:
        data = (html or "").encode()
        refers = largest.get(data) if len(data) >= 1000 and page_id != largest.get(data) else None
        yield page_id, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_round_trip(spark):
    archives = warc.write(frame(spark, ROWS).repartition(3), "page_id", "url", "html")
    out = warc.read(archives, keep_payload=True).collect()
    assert ordered(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in out) == ordered(expected(ROWS))
    for r in out:
        if r["record_type"] == "response":
            assert hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"]
        else:
            assert r["payload"] is None
    assert sum(a["records"] for a in archives.collect()) == len(ROWS)


def test_one_member_per_record(spark):
    archives = warc.write(frame(spark, ROWS), "page_id", "url", "html").collect()
    members = 0
    for a in archives:
        system, inner = warc.file_system(a["path"])
        data = system.open_input_stream(inner).read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == a["records"] and len(data) == a["bytes"]
        members += len(list(warc.read_records(io.BytesIO(data))))
    assert members == len(ROWS)


def archive(*records):
    return b"".join(gzip.compress(r) for r in records)


def test_damage_is_noticed():
    digest = hashlib.sha1(b"payload").hexdigest()
    good = warc.record(1, "u", b"payload", digest, None, "2026-01-01T00:00:00Z")
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(archive(good, good)))] == [1, 1]
    for bad in (
        archive(good.replace(b"payload", b"Payload")), archive(good)[:-12], archive(good[:-6]), archive(good + b"x"), good, archive(good) + b"junk",
        archive(good.replace(b"Content-Length: 7", b"Content-Length: 8")), archive(good.replace(b"WARC/1.1", b"WARC!1.1")),
    ):
        with pytest.raises(warc.BadRecord):
            list(warc.read_records(io.BytesIO(bad)))


def test_small_steps(monkeypatch):
    """Records longer than the steps in which they are read and decompressed."""
    monkeypatch.setattr(warc, "STEP", 7)
    payload = prose(6, 300).encode()
    raw = warc.record(5, "u", payload, hashlib.sha1(payload).hexdigest(), None, "2026-01-01T00:00:00Z")
    out = list(warc.read_records(io.BytesIO(archive(raw, raw)), keep_payload=True))
    assert [r["payload"] for r in out] == [payload, payload]


def test_empty_table(spark):
    assert warc.read(warc.write(frame(spark, []), "page_id", "url", "html")).collect() == []


def test_query(spark, data, monkeypatch):
    monkeypatch.setattr(check, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check, "ORACLES", queries.ORACLES)
    assert check.compare(spark, data, "op2_warc")[0] == "match"
