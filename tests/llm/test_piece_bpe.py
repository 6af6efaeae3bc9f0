from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tabforge.llm.piece_bpe import PieceModel, TextCoder, encode_documents, token_digests, with_ends

from .helpers import ODD_TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_and_round_trip_equal_the_library(model, library):
    rnd = random.Random(1)
    parts = [" ", "  ", "a", "b", "e", "t", "h", "in", "\n", "\t", "▁", "1", "23", "é", "ß", "日", "本", "😀", "\x00", ".", "!!",
             "aa", "    ", "the", "<s>", "<0x0A>", "ﬁ", "ing", "=", "--", "//", "**", "thethe", " "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(4000)]
    texts += [x for x in ODD_TEXTS if x is not None] + [" " * k + "a" * (k % 9) + " " * (k % 5) for k in range(80)] + ["ab" * 2000, "=" * 999]
    coder = TextCoder(model)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        expect = library.encode(text, add_bos=True, add_eos=True)
        assert with_ends(model, ids).tolist() == expect, text[:40]
        assert model.decode(with_ends(model, ids)) == library.decode(expect), text[:40]


def test_decode_of_any_ids(model, library):
    rnd = random.Random(2)
    for _ in range(1500):
        ids = [rnd.choice([rnd.randrange(3, 32000), rnd.randrange(3, 259), 1, 2]) for _ in range(10)]
        assert model.decode(np.array(ids)) == library.decode(ids)


def test_small_blocks_and_store(model, library, monkeypatch):
    from tabforge.llm import piece_bpe

    monkeypatch.setattr(piece_bpe, "BLOCK_CHARS", 7)
    monkeypatch.setattr(piece_bpe, "STORE_WORDS", 5)
    text = "some words  and\n\nmore   of them, twice twice" * 5
    assert TextCoder(model).encode([text, text])[1].tolist() == library.encode(text)


def test_documents(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD_TEXTS)] + [(None, "word", "x"), (5, "word", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = token_digests(docs, PATH).collect()
    expect = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        expect.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expect, key=str)
    full = {r.doc_id: r for r in encode_documents(docs.where("doc_id = 6"), PATH).collect()}
    assert full[6].ids == library.encode("Two Words", add_bos=True, add_eos=True) and full[6].decoded == "Two Words"
    assert token_digests(docs.limit(0), PATH).count() == 0
