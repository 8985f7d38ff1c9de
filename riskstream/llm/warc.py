"""Web archives of one Zstandard frame per record, with their dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskstream.llm.common import shuffle_partitions, written
from riskstream.workspace import shared_folder

# Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")

LEAST_BYTES = 1000              # a smaller payload is never a revisit
ARCHIVE_BYTES = 8 << 20         # an archive is closed beyond this size
DICTIONARY_BYTES = 32 << 10
SAMPLE_ROWS, SAMPLE_CHARS = 300, 20_000     # the dictionary is made from so many pages, none longer
DATE = "1970-01-01T00:00:00Z"


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from at most SAMPLE_ROWS pages of 1 to SAMPLE_CHARS characters, those with the smallest hash of page_id and
    url. The tasks send about twice as many pages, whatever their number; four times as many at most."""
    order = F.xxhash64("page_id", "url")
    share = min(1.0, (2 * SAMPLE_ROWS + 50) / max(1, pages.count()))
    drawn = pages.where(F.length("html").between(1, SAMPLE_CHARS) & (F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)))
    rows = drawn.select(order.alias("at"), "html").limit(4 * SAMPLE_ROWS).collect()
    samples = [r.html.encode() for r in sorted(rows)[:SAMPLE_ROWS]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:                 # too few or too alike: their text itself
        return b"".join(samples)[-DICTIONARY_BYTES:]


def record(page_id: int | None, url: str | None, html: str | None, original: int | None, date: str = DATE) -> bytes:
    """A record; a revisit of the page `original` if that is given, with the HTTP head alone."""
    payload = (html or "").encode()
    digest = hashlib.sha1(payload).hexdigest()
    name = lambda page: uuid.uuid5(uuid.NAMESPACE_URL, f"{page}:{digest}").urn
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if original is not None else head + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    fields = {
        "WARC-Type": "response" if original is None else "revisit", "WARC-Record-ID": f"<{name(page_id)}>",
        "WARC-Date": date, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    if original is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   "WARC-Refers-To": f"<{name(original)}>", "X-Refers-To-Page-ID": str(original)}
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items())]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, block) of a record, or ValueError: version, required fields, lengths, and a response's digest are checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("no record head")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.decode().partition(":")
        if not colon:
            raise ValueError(f"no field: {line!r}")
        fields[key.strip()] = value.strip()
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError(f"without {', '.join(missing)}")
    length = fields["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"{len(rest) - 4} bytes in a block of length {length}")
    block = rest[:-4]
    _, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP head")
    if fields["WARC-Type"] == "response" and fields.get("WARC-Payload-Digest") != "sha1:" + hashlib.sha1(payload).hexdigest():
        raise ValueError("another payload than its digest's")
    return fields, block


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each frame after the dictionary's; ValueError if the dictionary is missing or a frame is cut off."""
    if len(data) < 8:
        raise ValueError("no dictionary frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME or len(data) < 8 + size:
        raise ValueError("no dictionary frame")
    known = {"dict_data": zstandard.ZstdCompressionDict(data[8:8 + size])} if size else {}
    reader = zstandard.ZstdDecompressor(**known)
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        frame, parts, step = reader.decompressobj(), [], 1 << 12
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut off")
            try:
                parts.append(frame.decompress(view[at:at + step]))
            except zstandard.ZstdError as error:
                raise ValueError(f"no frame at byte {at}: {error}") from None
            at = min(at + step, len(data))
        at -= len(frame.unused_data)
        yield b"".join(parts)


def with_originals(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """`pages` with `original`: of pages with an equal payload of at least `least` bytes, the largest page_id, for
    all others. Rows of that page_id, repeated ones too, have none; without any page_id nor have the rest."""
    pages = pages.withColumn("_digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    groups = pages.where(F.octet_length("html") >= least).groupBy("_digest").agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n"))
    groups = written(groups.where("n > 1 AND largest IS NOT NULL").drop("n"), "payload-groups")
    joined = pages.join(groups, "_digest", "left")
    return joined.withColumn("original", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))).drop(
        "_digest", "largest")


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes a record per row of `pages` (page_id, url, html) to archives in `folder`, by default a new one in the
    cluster's shared place; returns the table of archives (path, records).

    Null html is an empty payload, a null url an empty one; a null page_id is left out of its record.
    A task's archives have its attempt in their names, and the table has those of tasks that succeeded,
    so what a lost executor or a second attempt leaves in the folder is never read. No rows: no archives.
    """
    dictionary = train_dictionary(pages)
    folder = folder or shared_folder(pages.sparkSession, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        known = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        writer = zstandard.ZstdCompressor(level=3, write_checksum=True, **known)
        prefix, paths, counts = f"{base}/part-{TaskContext.get().taskAttemptId():08d}", [], []
        file = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("page_id", "url", "html", "original")]
            for row in zip(*columns):
                if file is None:
                    paths.append(f"{prefix}-{len(paths):04d}.warc.zst")
                    counts.append(0)
                    file = store.open_output_stream(paths[-1])
                    file.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                file.write(writer.compress(record(*row)))
                counts[-1] += 1
                if file.tell() >= ARCHIVE_BYTES:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    rows = with_originals(pages.select("page_id", "url", "html"))
    return written(rows.select("page_id", "url", "html", "original").mapInArrow(run, "path string, records long"), "archive-list")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives (path, records): page_id, url, record_type, refers_to, payload_bytes,
    payload_digest and payload (null for a revisit). A record that breaks a rule, or an archive of
    another number of records, is an error. One archive is in a task's memory at a time.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pa.fs.FileSystem.from_uri(folder)
        whole = lambda text: None if text is None else int(text)
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist()):
                with store.open_input_stream(path) as file:
                    data = file.read()
                rows = []
                for frame in frames(data):
                    fields, block = parse_record(frame)
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    response = fields["WARC-Type"] == "response"
                    if response and size != len(payload):
                        raise ValueError(f"{path}: {len(payload)} bytes in a payload of {size}")
                    rows.append((whole(fields.get("X-Page-ID")), fields["WARC-Target-URI"], fields["WARC-Type"],
                                 whole(fields.get("X-Refers-To-Page-ID")), size,
                                 fields["WARC-Payload-Digest"].removeprefix("sha1:"), payload if response else None))
                if len(rows) != records:
                    raise ValueError(f"{path}: {len(rows)} records instead of {records}")
                for at in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 1000]), kinds)], names)

    spread = archives.repartition(shuffle_partitions(archives.sparkSession), "path")
    return spread.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                                  "payload_digest string, payload binary")
