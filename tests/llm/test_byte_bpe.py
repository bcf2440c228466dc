import hashlib
import random

import duckdb
import public_tokenizers
import pytest
import tiktoken

from citeloom.llm import byte_bpe as b


@pytest.fixture(scope="module")
def codec():
    return b.Codec(public_tokenizers.path(b.VOCABULARY))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids(library, text):
    return " ".join(map(str, library.encode_ordinary(text or "")))


def test_round_trip_and_library(codec, library):
    rnd = random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日本", "😀", "'s", "'t", "1", "23", "...", "!", "\x1c", "\x85", "\xa0", "​", "ß", "aaaa", "hello world", " x ", "ing", "\r\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["", None, " " * 500, "a" * 255, "a" * 256, "ab" * 129, "é" * 999, "b" * 1024, "ba" * 513, "x " * 4000 + " "]
    for text, (got, raw) in zip(texts, codec.run(texts), strict=True):
        assert got == ids(library, text) and raw == (text or "").encode(), text


def test_heap_equals_recursion(codec):
    rnd = random.Random(7)
    words = {"".join(rnd.choice("abeéinrst-=") for _ in range(rnd.randint(2, 60))) for _ in range(400)}
    codec.pieces = {}
    codec.encode_pieces(list(words))
    for w in words:
        if w.encode() not in codec.ranks:
            assert " ".join(map(str, codec._merge_long(w.encode()))) == codec.pieces[w][0]


def test_many_long_words_fit_the_memory(codec, library, monkeypatch):
    """One text of distinct words of 250 letters, dealt to several queries."""
    rnd = random.Random(8)
    text = " ".join("".join(rnd.choice("etaoinshrdlu") for _ in range(250)) for _ in range(3000))
    monkeypatch.setattr(b, "SQUARES", 50_000_000)
    codec.pieces, codec.plain, codec.spaced = {}, {}, {}
    ((got, raw),) = codec.run([text])
    assert got == ids(library, text) and raw == text.encode()
    monkeypatch.setattr(b, "CACHE_CHARS", 1000)
    assert codec.run(["short text"]) == [(ids(library, "short text"), b"short text")]
    assert codec.chars < 1000 and len(codec.pieces) < 10


def test_store_is_bounded(codec, library, monkeypatch):
    monkeypatch.setattr(b, "CACHE_PIECES", 50)
    texts = [f"word{i} other{i * 7}" for i in range(300)]
    for i in range(0, 300, 30):
        for t, (got, _) in zip(texts[i : i + 30], codec.run(texts[i : i + 30]), strict=True):
            assert got == ids(library, t)
        assert len(codec.spaced) <= 50 + 30


def test_query(spark, middle, library):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    rows = b.op9_byte_bpe(spark, middle).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = ids(library, texts[r.doc_id])
        assert r.n_tokens == len(want.split()) and r.ids_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, library):
    rows = [(None, None, "x"), (1, "", "x"), (2, "hi there", "x"), (2, "hi there", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in b.encode(docs).collect())
    assert got == [(0, "", b""), (1, "", b""), *[(2, ids(library, "hi there"), b"hi there")] * 2]
    assert b.encode(docs.where("false")).count() == 0
