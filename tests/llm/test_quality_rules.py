import random
import re
from collections import Counter

import duckdb

from citeloom.llm import quality_rules as q

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, cover = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            cover.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def failed(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_counts_equal_brute_force(spark):
    rnd = random.Random(2)
    parts = ["a", "b", "cc", " ", "\n", "\t", "\x0b", "\x0c", "\r", "  ", "é", "\xa0", "😀", "#", "<|>", "!", "the cat sat on the mat "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(400)] + [None, "", " \n ", "w " * 6000, "a\n\na\n a\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = q.features(rows).select("doc_id", "__q.*", q.base_failed().alias("f")).collect()
    for r in got:
        want = brute(texts[r.doc_id])
        assert tuple(r[c] for c in BASE) == want, texts[r.doc_id]
        assert r.f == failed(want)


def test_query(spark, middle):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{middle}/labels.parquet'").fetchall())
    rows = {r.doc_id: r for r in q.op2_quality_rules(spark, middle).collect()}
    assert set(rows) == set(texts)
    for i, r in rows.items():
        assert tuple(r[c] for c in BASE) == brute(texts[i])
        assert r.base_failed == failed(brute(texts[i])) and not (r.kept and r.base_failed)
    judged = [i for i in labels if not rows[i].base_failed]
    assert sum(rows[i].kept == bool(labels[i]) for i in judged) / len(judged) > 0.98
    assert all(rows[i].kept for i in judged if labels[i])


def test_base_counts_equal_their_sql(same, middle):
    assert same(q.quality_base_counts, q.ORACLES["quality_base_counts"], middle) == 1000


def test_expectations_vanish_as_rows_grow():
    """Rates that contradict what EM starts from win over it, the more so the more rows there are."""
    often = {tuple([-1] * 7): 3, tuple([0] * 7): 5, tuple([1] * 7): 2}
    off = [abs(q.expectation_maximisation({k: n * v for k, v in often.items()}).rates[0][1][1] - q.START[1][1]) for n in (10, 1000, 100_000)]
    assert off[0] < off[1] < off[2]


def test_em_finds_rates_without_labels():
    rnd = random.Random(3)
    patterns = Counter()
    for _ in range(4000):
        bad = rnd.random() < 0.2
        patterns[tuple((-1 if rnd.random() < 0.6 else 1) if bad else (-1 if rnd.random() < 0.02 else 1) for _ in q.NAMES)] += 1
    model = q.expectation_maximisation(patterns)
    assert abs(model.prior - 0.8) < 0.05
    assert all(rates[0][0] > 0.4 and rates[0][1] < 0.05 and model.accuracy(j) > 0.8 for j, rates in enumerate(model.rates))
    assert q.expectation_maximisation({}).prior == q.START_PRIOR


def test_keep_good_keeps_columns_and_odd_rows(spark):
    good = "A plain text of a dozen common words, which no rule has reason to doubt."
    rows = [(1, good, "x"), (1, good, "x"), (None, good, None), (2, None, "y"), (3, "few words", "z"), (4, "*** $$$ " * 40, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.kept) for r in kept.collect()) == [(0, None), (1, "x"), (1, "x")]
    assert q.keep_good(docs.where("false")).count() == 0


def test_plan_is_native(spark, middle):
    plan = q.features(spark.read.parquet(f"{middle}/documents.parquet")).select(q.kept(q.expectation_maximisation({})))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())
