import re

from pyspark.sql import functions as F

from citeloom.llm import exact_dedup as x

ODD = [(1, "A", 9), (1, "a", 8), (1, "a", 8), (2, None, 1), (None, "", 2), (None, None, 3), (3, "b", 1), (5, "É", 1), (6, "é", 1), (7, "x" * 300 + "1", 1), (8, "X" * 300 + "2", 1), (9, "x" * 300 + "2", 1)]
SCHEMA = "doc_id long, text string, kept int"


def test_query(same, middle):
    assert same(x.op6_exact_dedup, x.ORACLE, middle) == 1000


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    rows = x.duplicate_groups(docs).collect()
    assert len(rows) == len(ODD)
    stays = sorted((r.doc_id, r.keep_id, r.group_size) for r in rows if r.kept)
    assert stays == [(1, 1, 3), (2, 2, 3), (3, 3, 1), (5, 5, 1), (6, 6, 1), (7, 7, 1), (9, 9, 2)]
    assert x.duplicate_groups(docs.where("false")).count() == 0


def test_keep_distinct(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    kept = x.keep_distinct(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7, 9]
    unique = docs.where("doc_id >= 3")
    assert sorted(r.doc_id for r in x.keep_distinct(unique).collect()) == [3, 5, 6, 7, 9]
    nameless = docs.where("doc_id IS NULL")
    assert x.keep_distinct(nameless).count() == 1
    assert x.keep_distinct(docs.where("false")).count() == 0


def test_without_broadcasts(spark, middle, same, monkeypatch):
    monkeypatch.setattr(x, "BROADCAST_ROWS", 0)
    assert same(x.op6_exact_dedup, x.ORACLE, middle) == 1000
    monkeypatch.setattr(x, "HOT_ROWS", 2)  # and large groups by themselves
    assert same(x.op6_exact_dedup, x.ORACLE, middle) == 1000
    docs = spark.createDataFrame(ODD, SCHEMA)
    assert sorted(r.doc_id for r in x.keep_distinct(docs).collect()) == [1, 2, 3, 5, 6, 7, 9]


def test_a_bitmap_lets_every_listed_group_through(spark, monkeypatch):
    rows = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    groups = rows.where("a % 9 = 0")
    for bits in (1 << 27, 1 << 16):
        monkeypatch.setattr(x, "BITS", bits)
        monkeypatch.setattr(x, "BROADCAST_ROWS", 0)
        got = {r.a: r["__shared"] for r in x._flagged(rows, groups, ["a", "b"]).collect()}
        assert len(got) == 5000 and all(got[i] for i in range(0, 5000, 9))
        assert sum(got.values()) - 556 < (10 if bits > 1 << 20 else 400)


def test_plan_is_native(spark, middle):
    plan = x.keep_distinct(spark.read.parquet(f"{middle}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
