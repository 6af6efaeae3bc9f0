from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tabforge.llm.common import stage

from .helpers import ODD_TEXTS
from .test_line_runs import brute as brute_lines
from .test_ngram_join import brute as brute_groups

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_on_documents_with_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit("clash"))
    odd = spark.createDataFrame([(9000 + i, t, None, None, None, "c") for i, t in enumerate(ODD_TEXTS)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3))
    stages = dict(corpus_pipeline.STAGES)
    first = stage(stages["quality"](spark, docs, SF), "t")
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    left = {i for i, _ in texts(first)}
    assert len(good - left) <= 0.02 * len(good) and len(bad & left) <= 0.1 * len(bad)
    second = stage(stages["line_dedup"](spark, first, SF), "t")
    assert Counter(texts(second)) == Counter((i, t if not d or t is None else k) for (i, t), (_, _, d, k) in
                                             zip(sorted(texts(first), key=str), brute_lines(sorted(texts(first), key=str), 10), strict=True))
    third = stage(stages["near_duplicates"](spark, second, SF), "t")
    groups = brute_groups(texts(second))
    assert {i for i, _ in texts(third)} == {i for i, _, c in groups if i == c}
    assert third.count() == third.select("doc_id").distinct().count()
    fourth = stage(stages["source_mix"](spark, third, SF), "t")
    times = Counter(i for i, _ in texts(fourth))
    assert max(times.values()) <= 2 and set(times) <= {i for i, _ in texts(third)}
    for df in (first, second, third, fourth):
        assert df.columns == docs.columns
    last = stages["encode"](spark, fourth, SF).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expect = Counter()
    for i, t in texts(fourth):
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        expect[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())] += 1
    assert Counter(map(tuple, last)) == expect


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0


def test_near_duplicates_decides_row_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (5, b), (5, ""), (5, a),               # equal ids, other texts, an empty one and a repeated row
            (1, c), (5, c + " x"), (None, c + " y"),       # copies of document 1
            (None, d), (None, d), (None, None)]            # without an id, copies of no document that has one
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    got = texts(dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, SF))
    assert Counter(got) == Counter([(5, a), (5, b), (5, ""), (1, c), (None, d), (None, d), (None, None)])
