"""WARC archives compressed record by record with a shared Zstandard dictionary.

A file begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; each record follows as a Zstandard frame of its own. The dictionary
is trained on a bounded sample of the records to be archived.

Equal payloads are stored once: the record with the largest page_id is the
response, the others are revisit records that name it.
"""

from __future__ import annotations

import base64
import io
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_folder, least_hashed, open_store, stage, store_uri

#: Fixed values of the WARC 1.1 and Zstandard formats.
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space

DICT_BYTES = 64 << 10
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 16 << 10
FILE_BYTES = 1 << 30


def train_dictionary(pages: DataFrame, rows: int = SAMPLE_ROWS, row_bytes: int = SAMPLE_BYTES,
                     dict_bytes: int = DICT_BYTES) -> bytes:
    """A dictionary from the ``rows`` payloads of least hash, the first ``row_bytes`` of each.

    The sample is at most rows * row_bytes on the driver. Too little text for
    training gives an empty dictionary, and the records are compressed alone.
    """
    import zstandard

    drawn = least_hashed(pages.select("page_id", "payload"), rows, "page_id")
    sample = [r for r in drawn.select(F.substring("payload", 1, row_bytes).alias("p")).collect() if len(r.p) > 8]
    # training alone needs a few samples and far more bytes than the dictionary
    if len(sample) < 16 or sum(len(r.p) for r in sample) < 8 * dict_bytes:
        return b""
    return zstandard.train_dictionary(dict_bytes, [bytes(r.p) for r in sample]).as_bytes()


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page:{page_id}')}>"


def _line(value: str) -> str:
    """A header value on one line: controls and blanks percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def build_record(page_id, url, payload: bytes | None, size: int, sha1_hex: str, refers_to) -> bytes:
    """One WARC record; ``payload`` is None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_line(url) if url else f'urn:page:{page_id}'}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http;msgtype=response", f"X-Page-ID: {'' if page_id is None else page_id}"]
    if payload is None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(raw) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a binary file object."""
    import zstandard

    magic, size = struct.unpack("<II", raw.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the start of the archive")
    known = raw.read(size)
    tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known) if known else None)
    stream = io.BufferedReader(tool.stream_reader(raw, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record does not start with its version")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().partition(": ")
            head[name] = value.rstrip("\r\n")
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end with two line ends")
        yield head, block


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (null for revisits), size, sha1, refers_to.

    Of rows with equal payloads of at least ``min_bytes``, those of the largest
    page_id are responses and the others refer to it; a null page_id is smaller
    than any other, and rows without any page_id are all responses.
    """
    digest = pages.withColumns({"sha1": F.sha1("payload"), "size": F.length("payload").cast("long")})
    first = (digest.where(F.col("size") >= min_bytes).groupBy(F.col("sha1").alias("of"), F.col("size").alias("of_size"))
             .agg(F.max("page_id").alias("keeper")))
    out = digest.join(first, (F.col("sha1") == F.col("of")) & (F.col("size") == F.col("of_size")), "left")
    again = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return out.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "sha1",
                      F.when(again, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES, level: int = 3) -> DataFrame:
    """Archive ``pages`` (page_id integer, url, html); returns a written stage (path, records, bytes).

    The payload is the html in UTF-8, empty when null. Each task writes files of
    about ``file_bytes`` below the shared folder; a task that runs again writes
    other files, and only the committed rows name files.
    """
    folder = store_uri(fresh_folder(pages.sparkSession, "warc"))
    plain = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    known = train_dictionary(plain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tool = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(known) if known else None,
                                        write_content_size=True)
        sink = path = None
        count = size = 0

        def close() -> pa.RecordBatch:
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())],
                                              ["path", "records", "bytes"])

        for batch in batches:
            for row in range(batch.num_rows):
                if sink is None:
                    path, count = f"{folder}/part-{uuid.uuid4().hex}.warc.zst", 0
                    store, place = open_store(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    sink = store.open_output_stream(place, compression=None)
                    sink.write(struct.pack("<II", SKIPPABLE, len(known)) + known)
                    size = 8 + len(known)
                page_id, url, payload, n, sha1, refers_to = (c[row].as_py() for c in batch.columns)
                frame = tool.compress(build_record(page_id, url, payload, n, sha1, refers_to))
                sink.write(frame)
                size += len(frame)
                count += 1
                if size >= file_bytes:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()

    return stage(with_references(plain, min_bytes).mapInArrow(run, "path string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of each record of the files in column path.

    A response's digest is checked against its payload; a damaged record raises
    an error.
    """
    import hashlib

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = open_store(path)
                out: list[tuple] = []
                with store.open_input_stream(place, compression=None) as raw:
                    for head, block in read_records(raw):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = head["WARC-Type"]
                        if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{path}: a payload does not match its digest")
                        out.append((int(head["X-Page-ID"]) if head["X-Page-ID"] else None, head["WARC-Target-URI"], size, digest, kind,
                                    int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None))
                        if len(out) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                            out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    spread = files.select("path").repartition(max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "path")
    return spread.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")
