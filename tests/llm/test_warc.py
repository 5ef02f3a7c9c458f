from __future__ import annotations

import base64
import gzip
import hashlib
import pathlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystick.llm import queries, warc
from tallystick.sources.workspace import new_folder

PAGES = [
    (1, "http://a/ b\r\nx", "<p>one</p>"), (2, None, "<p>one</p>"), (5, "http://c", "<p>one</p>"), (None, "http://d", "<p>one</p>"),
    (3, "http://e", None), (4, "http://f", ""), (6, "http://g", "a\r\n\r\nWARC/1.1\r\n\r\nb\r\n\r\n"), (7, "http://h", "\r\n" * 3),
    (8, "http://i", "é\U0001f600\x00"), (9, "http://j", "long " * 50_000), (9, "http://j", "long " * 50_000),
]


def expected(pages):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    latest = {}
    for i, _, html in pages:
        latest[digest(html)] = max((x for x in (i, latest.get(digest(html))) if x is not None), default=None)
    rows = []
    for i, _, html in pages:
        best = latest[digest(html)]
        revisit = best is not None and i != best
        rows.append((i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", best if revisit else None))
    return sorted(rows, key=str)


def run(spark, tmp_path, pages):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op1_warc_normalise(spark, str(tmp_path))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_pages_come_back(spark, tmp_path):
    assert run(spark, tmp_path, PAGES) == expected(PAGES)


def test_no_pages(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def test_index_cuts_out_every_record(spark):
    pages = spark.createDataFrame([(i, u, (h or "").encode()) for i, u, h in PAGES], "page_id long, target_uri string, payload binary")
    records = warc.with_revisits(pages, "page_id").selectExpr("*", "concat('urn:', page_id) record_id", "concat('urn:', original) refers_to")
    single, many = new_folder(spark, "single"), new_folder(spark, "many")
    warc.write_monolithic(records, single)
    warc.normalise(spark, single, many)
    root = pathlib.Path(many.removeprefix("file:"))
    whole = {p.name.split(".")[0]: p.read_bytes() for p in (root / "archives").glob("*.warc.gz")}
    index = warc.read_index(spark, many).collect()
    assert len(index) == len(PAGES)
    for entry in index:
        record = warc.inflate_at(whole[entry["archive"]], entry["offset"], entry["length"])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: <{entry['record_id'] or ''}>".encode() in record
    for name, data in whole.items():
        assert sum(e["length"] for e in index if e["archive"] == name) == len(data)
        assert gzip.decompress(data).count(b"WARC-Record-ID: <") == sum(e["archive"] == name for e in index)


def test_record_limit_of_the_session_loses_nothing(spark, tmp_path):
    pages = [(i, f"http://{i}", f"page {i}") for i in range(40)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "5")
    try:
        assert run(spark, tmp_path, pages) == expected(pages)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_files_that_cannot_be_moved_are_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "_moved", lambda *_: False)
    with pytest.raises(OSError, match="cannot move"):
        run(spark, tmp_path, PAGES)


def test_index_and_archives_are_counted_against_each_other(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "read_index", lambda *_: spark.range(3))
    with pytest.raises(OSError, match="but 3 in"):
        run(spark, tmp_path, PAGES)


def test_min_bytes_leaves_small_payloads_alone(spark):
    pages = spark.createDataFrame([(1, b"ab"), (2, b"ab"), (3, b"abcd"), (4, b"abcd")], "id long, payload binary")
    kinds = {r["id"]: r["record_type"] for r in warc.with_revisits(pages, "id", min_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_long_records_become_a_run_of_members():
    data = bytes(range(256)) * 40
    run = warc.gzip_members(data, size=1000)
    assert run.count(b"\x1f\x8b\x08") >= 11 and run.endswith(b"\0")
    assert warc.inflate_at(b"xx" + run + b"yy", 2, len(run)) == data


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("\r\nab", max_size=12).map(str.encode), max_size=5), st.integers(1, 7))
def test_parser_joins_any_pieces(payloads, step):
    import pandas as pd

    stream = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(p), p) for p in payloads)
    pieces = stream.split(b"\r\n\r\n")
    pieces = pieces if pieces[-1] else pieces[:-1]  # Spark's text source gives no empty last line
    batches = [pd.DataFrame({"file": "f", "value": pieces[i : i + step]}) for i in range(0, len(pieces), step)]
    assert [block for _, _, block in warc.parse(batches)] == payloads


@pytest.mark.parametrize("stream", ["WARC/1.1\r\nContent-Length: 50\r\n\r\nshort", "junk without header", "WARC/1.1\r\nX: 1\r\n\r\n"])
def test_damage_is_reported(spark, tmp_path, stream):
    path = tmp_path / "archives"
    path.mkdir()
    (path / "0.warc.gz").write_bytes(gzip.compress(stream.encode()))
    with pytest.raises(Exception, match="ValueError"):
        warc.read_archives(spark, str(tmp_path)).collect()
