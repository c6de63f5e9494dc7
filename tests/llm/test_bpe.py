import hashlib
import random

import pytest

from gridcube.llm import bpe as B
from gridcube.llm import queries as Q
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def enc():
    return B.load(*Q.tokenizer())


def test_pieces_encode_like_the_whole(enc, monkeypatch):
    rng = random.Random(1)
    bits = ["word", "é", "don't", "  ", " ", "\n", "12", "😀", "!!", " ", "\t", "x", "ñandú", "'s", " 's"]
    monkeypatch.setattr(B, "LONG", 7)
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([1, 10, 80])))
        assert [i for p in B.pieces(text, 7) for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text) == B.encode_text(enc, text)
        assert "".join(B.pieces(text, 7)) == text


def test_long_text_without_a_safe_place(enc):
    text = "é" * (B.LONG + 500)
    assert enc.decode_bytes(B.encode_text(enc, text)) == text.encode()


def test_round_trip_of_all_documents(spark, enc):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r for r in Q.op8_bpe(spark, SF_SMALL).collect()}
    for r in docs.collect():
        ids = enc.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (2, "<|endoftext|>", 1), (2, "<|endoftext|>", 1)], "doc_id long, text string, token_ids int")
    rows = B.decode(B.encode(docs, *Q.tokenizer()), *Q.tokenizer()).collect()
    assert sorted(bytes(r.decoded) for r in rows) == [b"", b"", b"<|endoftext|>", b"<|endoftext|>"]
    assert [len(r.token_ids) for r in rows if not r.text] == [0, 0]
    assert B.encode(docs.limit(0), *Q.tokenizer()).count() == 0
