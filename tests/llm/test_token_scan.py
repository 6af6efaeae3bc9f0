from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from tabforge.llm.token_scan import byte_bpe_encoder, document_token_counts, scan_token_files

from .helpers import ODD_TEXTS

END = 50256


def test_documents_against_the_library(spark):
    make = byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = [(i, t, 1) for i, t in enumerate(ODD_TEXTS)] + [(None, "word", 1), (5, "word again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ordinal int")
    encode = make()
    expect = sorted([(i, len(encode(t or ""))) for i, t, _ in rows], key=str)
    for block in (3, 1000):
        assert sorted(map(tuple, document_token_counts(docs, make, END, block).collect()), key=str) == expect
    assert document_token_counts(docs.limit(0), make, END).count() == 0


def test_blocks_stitch(spark, tmp_path):
    files = {"a": [1, 2, END, END, 3, END], "b": [], "c": [7] * 25, "d": [END] * 5, "e": [1] * 11 + [END] + [2] * 9}
    for name, ids in files.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    paths = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in list(files) + ["a"]], "path string")
    expect = []
    for name, ids in files.items():
        start = k = 0
        for i, t in enumerate(ids):
            if t == END:
                expect.append((name, k, start, i - start, True))
                start, k = i + 1, k + 1
        if start < len(ids):
            expect.append((name, k, start, len(ids) - start, False))
    for block in (1, 2, 4, 100):
        got = scan_token_files(paths, END, block).collect()
        assert sorted((r.path.rpartition("/")[2], r.ordinal, r.start, r.n_tokens, r.closed) for r in got) == sorted(expect)


def test_odd_file_is_an_error(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="odd number of bytes"):
        scan_token_files(spark.createDataFrame([(f"file://{tmp_path}/odd",)], "path string"), END).collect()
