import itertools
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from citeloom.llm import components as c
from citeloom.llm import ngram_join as n


def brute(rows):
    """(class, links) of each id, over all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = n._SPLIT.findall((text or "").lower())
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    where, both, links, parent = defaultdict(list), Counter(), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        both.update(itertools.combinations(ids, 2))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), k in both.items():
        if 5 * k >= 4 * (len(sets[a]) + len(sets[b]) - k):
            links[a] += 1
            links[b] += 1
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: (root(i), links[i]) for i in sets}


def answers(df):
    return {r.doc_id: (r.class_id, r.n_links) for r in df.collect()}


def test_bands():
    bands, rows = n.choose_bands(0.8, 0.9999, 192)
    assert bands * rows <= 192 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    assert (n.BANDS, n.ROWS) == (bands, rows)


def test_query_equals_brute_force(spark, middle, monkeypatch):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall()
    want = brute(rows)
    assert answers(n.op3_ngram_jaccard_join(spark, middle)) == want
    monkeypatch.setattr(n, "BLOCK", 2000)  # groups over several blocks
    assert answers(n.op3_ngram_jaccard_join(spark, middle)) == want


def test_query_equals_its_sql(same, middle):
    assert same(n.op3_ngram_jaccard_join, n.ORACLE, middle) == 1000


def test_chains_ties_and_a_large_group(spark, monkeypatch):
    words = [f"w{i}" for i in range(104)]
    rows = [(0, " ".join(words))]
    for i in range(1, 40):  # a chain: each differs from the last by one word
        words = [*words[1:], f"x{i}"]
        rows.append((i, " ".join(words)))
    base = [f"b{i}" for i in range(13)]
    rows += [(100, " ".join(base)), (101, " ".join([*base[:-1], "other"])), (102, " ".join([*base, "more"]))]  # 8 of 10 shingles, 9 of 10
    rows += [(200 + i, " ".join([f"c{k}" if k != i * 7 else "z" for k in range(200)])) for i in range(25)]
    rows += [(300 + i, rows[-1][1].upper()) for i in range(5)]
    monkeypatch.setattr(n, "BLOCK", 600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert answers(n.link_documents(docs)) == brute(rows)


def test_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near = base.replace("w3 ", "x ")
    rows = [(1, "a b c"), (2, "A B  c"), (3, None), (4, ""), (None, "a b c"), (5, base), (5, "another text of the same id that is like no other"), (6, near), (6, near), (7, base + " tail"), (8, "  ")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, class_id int")
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in n.link_documents(docs).collect()), key=str)
    want = [(1, 1, 1, 0), (2, 1, 1, 0), (3, 3, 0, 0), (4, 4, 0, 0), (None, None, 0, 0), (5, 5, 3, 2), (5, 5, 0, 0), (6, 5, 3, 2), (6, 5, 3, 2), (7, 5, 3, 2), (8, 8, 0, 0)]
    assert got == sorted(want, key=str)
    kept = n.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 5, 8]
    assert n.link_documents(docs.where("false")).count() == n.keep_one_of_each(docs.where("false")).count() == 0


def test_one_of_each_class_stays_where_ids_repeat(spark):
    base = [f"w{i}" for i in range(60)]
    text = lambda *changed: " ".join("x" if i in changed else w for i, w in enumerate(base))
    lone, other = "a text that is like no other here", " ".join(f"v{i}" for i in range(40))
    rows = [(5, text()), (5, text(1)), (5, lone), (6, text(58)), (7, other), (9, other + " tail"), (9, "a b c"), (9, "a b c"), (9, None), (9, ""), (None, lone)]
    docs = spark.createDataFrame([(t, i, {"k": 1}) for i, t in rows], "text string, doc_id long, more map<string,int>").repartition(3)
    kept = n.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    ours = [(i, t) for i, t in got if t and t.startswith("w0")]
    assert len(ours) == 1 and ours[0][0] == 5
    assert sorted((x for x in got if x not in ours), key=str) == sorted([(5, lone), (7, other), (9, "a b c"), (9, None), (9, ""), (None, lone)], key=str)


def test_similar_matrix(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25))).astype(np.int64) for _ in range(60)]
    monkeypatch.setattr(n, "COLUMNS", 7)
    shared = n.Shared(sets)
    for a, b in (((0, 60), (0, 60)), ((0, 20), (20, 60)), ((13, 14), (50, 55))):
        got = shared.similar(a, b)
        for i, j in itertools.product(range(*a), range(*b)):
            k = len(np.intersect1d(sets[i], sets[j]))
            assert got[i - a[0], j - b[0]] == (5 * k >= 4 * (len(sets[i]) + len(sets[j]) - k))


def test_links_over_tiles_equal_all_pairs(monkeypatch):
    rng = np.random.default_rng(6)
    base = [rng.integers(0, 10**9, 40) for _ in range(4)]
    sets = [np.unique(np.where(rng.random(40) < rng.choice([0.02, 0.1, 0.3]), rng.integers(0, 10**9, 40), base[i % 4])).astype(np.int64) for i in range(90)]
    node, copies, side = rng.permutation(90).astype(np.int64) + 1000, rng.integers(1, 5, 90), rng.integers(1, 3, 90)
    for sides in (np.zeros(90, dtype=np.int64), side):
        link = n.Shared(sets).similar((0, 90), (0, 90))
        np.fill_diagonal(link, False)
        if sides.any():
            link &= sides[:, None] != sides[None, :]
        reach = link | np.eye(90, dtype=bool)
        for _ in range(7):
            reach = reach @ reach
        want = {int(node[i]): (int(node[reach[i]].min()), int(link[i].sum()), int(copies[link[i]].sum())) for i in range(90) if link[i].any()}
        for tile in (1, 7, 1024):
            monkeypatch.setattr(n, "TILE", tile)
            assert {x: tuple(rest) for x, *rest in n._links(node, copies, sides, sets)} == want


def test_a_large_group_moves_each_set_once(spark):
    """A group of 2500 different near copies is one task, and right."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert set(answers(n.link_documents(docs)).values()) == {(0, 2499)}
    assert 2500 * 57 < n.BLOCK


def test_components(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, i) for i in range(5001, 5200)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.root for r in c.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert got == want
    with pytest.raises(RuntimeError):
        c.components(spark.createDataFrame(edges, "a long, b long"), rounds=1)
    monkeypatch.setattr(c, "BROADCAST_ROWS", 0)  # the salted join
    again = {r.node: r.root for r in c.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert again == want
