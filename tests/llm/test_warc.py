import hashlib
import struct
from collections import defaultdict

import pytest
import zstandard

from riskstream.llm.queries import op2_warc
from riskstream.llm.warc import frames, parse_record, read_archives, record, write_archives
from riskstream.workspace import shared_folder

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, original string"


def expected(pages):
    groups = defaultdict(list)
    for page, html in pages:
        groups[(html or "").encode()].append(page)
    rows = []
    for page, html in pages:
        data = (html or "").encode()
        largest = max((p for p in groups[data] if p is not None), default=None)
        revisit = len(data) >= 1000 and largest is not None and page != largest
        rows.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(rows, key=repr)


def test_query(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, op2_warc(spark, SF).collect()), key=repr) == expected(pages)


def test_odd_rows_and_revisits(spark):
    big, edge = "<p>é</p>" * 300, "x" * 1000
    pages = [(1, "http://a/\n b", big), (5, None, big), (3, "u", big), (3, "u", big), (5, "again", big), (None, "u", big),
             (7, "u", None), (8, "u", ""), (9, "u", "x" * 999), (10, "u", "x" * 999), (11, "u", edge), (12, "u", edge),
             (None, "u", "only" * 400), (None, "u", "only" * 400), (13, "u", "<html>" + "y " * 500_000)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], PAGES)
    folder = shared_folder(spark, "archives")
    archives = write_archives(df, folder)
    found = read_archives(archives, folder).collect()
    plain = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=repr)
    assert plain == expected([(p, h) for p, _, h in pages])
    assert all((r.payload is None) == (r.record_type == "revisit") for r in found)
    assert sum(r.records for r in archives.collect()) == len(pages)
    empty = write_archives(df.where("false"), folder := shared_folder(spark, "archives"))
    assert read_archives(empty, folder).count() == 0


def archive(*records, dictionary=b"some words that repeat"):
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return struct.pack("<II", 0x184D2A5D, len(dictionary)) + dictionary + b"".join(map(writer.compress, records))


def test_frames_are_read_one_by_one():
    records = [record(i, "u", "some words that repeat " * i, None) for i in range(400)]
    assert list(frames(archive(*records))) == records


@pytest.mark.parametrize("change", [
    lambda d: d[:-5], lambda d: d[:6], lambda d: b"\x28" + d[1:], lambda d: d + b"junk", lambda d: d[8:]])
def test_broken_archives_are_refused(change):
    with pytest.raises(ValueError):
        list(frames(change(archive(record(1, "u", "text", None)))))


@pytest.mark.parametrize("change", [
    lambda d: d.replace(b"WARC/1.1", b"WARC/9.9"), lambda d: d.replace(b"WARC-Date", b"X-Date"), lambda d: d + b"x", lambda d: d[:-1],
    lambda d: d.replace(b"text", b"tixt"), lambda d: d.replace(b"Content-Length: ", b"Content-Length: x")])
def test_broken_records_are_refused(change):
    good = record(1, "u", "text", None)
    parse_record(good)
    with pytest.raises(ValueError):
        parse_record(change(good))
