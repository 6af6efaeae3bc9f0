from __future__ import annotations

import base64
import hashlib
import random
import struct

import zstandard

from tabforge.llm.warc import SKIPPABLE, read_archives, write_archives

from .helpers import prose


def brute(rows, min_bytes=0):
    keeper = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= min_bytes:
            keeper[p] = max(keeper.get(p, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        best = keeper.get(p, -1)
        again = best >= 0 and i != best
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=str)


def rows_of(seed):
    rnd = random.Random(seed)
    bodies = [prose(rnd, 300) for _ in range(40)] + [None, "", "\r\n\r\nWARC/1.1\r\n", "É日😀", "x" * 200_000]
    rows = [(i, rnd.choice([None, "", f"http://h/{i}", "http://h/a b\r\nX: y", "http://é/"]), rnd.choice(bodies)) for i in range(200)]
    return rows + [rows[3], (None, None, bodies[0]), (None, "u", "only without id")]


def test_round_trip(spark):
    rows = rows_of(1)
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    for min_bytes in (0, 500):
        files = write_archives(pages, min_bytes)
        got = read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, min_bytes)
    assert sum(r.records for r in files.collect()) == len(rows)


def test_file_layout_and_rolling(spark):
    rnd = random.Random(2)
    pages = spark.createDataFrame([(i, f"http://h/{i}", prose(rnd, 2000)) for i in range(400)], "page_id long, url string, html string")
    files = write_archives(pages, file_bytes=200_000).collect()
    assert len(files) > 2
    for f in files:
        raw = open(f.path.removeprefix("file://"), "rb").read()
        assert len(raw) == f.bytes
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == SKIPPABLE and size > 1000
        # each record is a frame of its own
        tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
        rest, frames = raw[8 + size:], 0
        while rest:
            one = tool.decompressobj()
            assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest, frames = one.unused_data, frames + 1
        assert frames == f.records
    spread = spark.createDataFrame([(f.path,) for f in files], "path string")
    assert read_archives(spread).count() == 400


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(write_archives(empty)).count() == 0
