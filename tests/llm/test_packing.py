import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citeloom.llm import packing as k


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path(k.VOCABULARY))
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_library(library):
    rnd = random.Random(3)
    parts = ["a", "The", " ", "  ", "\n", "\t", "é", "É", "日本", "😀", "'s", "'T", "1", "23", "...", "!", "\x1c", "\x85", "\xa0", "​", "ß", "aaaa", "é", "İ", "Σ", "<|endoftext|>", "ſ", "Ⅷ", "ﬁ", "K"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + ["", None, "a" * 3000, " " * 500]
    mine = k.WordTokenizer(public_tokenizers.path(k.VOCABULARY)).encode(texts)
    for t, ids in zip(texts, mine, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def used(plan):
    out = Counter()
    for pattern, times in plan:
        for length, n in pattern:
            out[length] += n * times
    return {x: n for x, n in out.items() if n}


def test_plans_hold_every_piece_and_fit():
    rnd = random.Random(4)
    for capacity in (8, 40, 2048):
        for _ in range(30):
            counts = {rnd.randint(1, capacity): rnd.randint(1, 50) for _ in range(rnd.randint(1, 40))}
            plan = k.make_plan(counts, capacity)
            assert used(plan) == counts
            assert all(sum(x * n for x, n in p) <= capacity and times > 0 for p, times in plan)
            total = sum(x * n for x, n in counts.items())
            assert -(-total // capacity) <= sum(t for _, t in plan)
    assert k.make_plan({}) == []


def test_exact_complements_are_found():
    full = lambda counts, cap=10: sum(t for _, t in k.make_plan(counts, cap))
    assert full({7: 5, 3: 5}) == 5  # single
    assert full({6: 5, 3: 5, 1: 5}) == 5  # pair
    assert full({4: 3, 3: 3, 2: 3, 1: 3}) == 3  # triple
    assert full({5: 4}) == 2 and full({5: 3}) == 2 and full({2: 15}) == 3
    rnd = random.Random(5)
    counts = Counter(min(2048, int(rnd.lognormvariate(5.8, 1.1)) + 1) for _ in range(20_000))
    total = sum(x * n for x, n in counts.items())
    assert sum(t for _, t in k.make_plan(counts)) <= -(-total // 2048) * 1.002


def check(rows, capacity=k.CAPACITY):
    """Sequences are gapless from 0 and within capacity."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_query(spark, middle, library):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    rows = k.op7_best_fit_packing(spark, middle).collect()
    n = check(rows)
    total = sum(r.length for r in rows)
    assert n <= -(-total // k.CAPACITY) * 1.01 + 1
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    for i, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, k.END_ID]
        for p, at in enumerate(range(0, len(ids), k.CAPACITY)):
            r = pieces.pop((i, p))
            part = np.array(ids[at : at + k.CAPACITY], dtype="<u4")
            assert (r.start, r.length, r.ids_crc32) == (at, len(part), zlib.crc32(part.tobytes()))
    assert not pieces


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(k, "GROUP_PIECES", 2)
    rows = [(1, "one two", 0), (1, "one two", 0), (None, None, 1), (2, "", 2), (3, "word " * 5000, 3), *[(10 + i, "same words here", 0) for i in range(40)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = k.pack(docs, with_ids=True)
    got = out.collect()
    check(got)
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in got if (r.doc_id or 0) < 10) == [(0, 0, 0, 1), (1, 0, 0, 3), (1, 0, 0, 3), (2, 0, 0, 1), (3, 0, 0, 2048), (3, 1, 2048, 2048), (3, 2, 4096, 905)]
    assert all(len(r.ids) == r.length for r in got) and len(got) == len(rows) + 2
    assert k.pack(docs.where("false")).count() == 0
