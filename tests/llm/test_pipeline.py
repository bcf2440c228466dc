import duckdb
from test_ngram_join import brute as near
from test_packing import check
from test_pii import brute as private

import corpus_pipeline
from citeloom.llm import quality_rules

STAGES = ["quality_rules", "exact_dedup", "ngram_join", "pii", "packing"]


def test_stages_against_brute_force(spark, middle, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == STAGES and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, middle).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{middle}/documents.parquet'").fetchall())
    good = {r.doc_id for r in quality_rules.op2_quality_rules(spark, middle).where("kept").collect()}
    assert set(kept["quality_rules"]) == good

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {texts[i].translate(lower): i for i in sorted(good)}
    assert set(kept["exact_dedup"]) == set(last.values())

    classes = near([(i, texts[i]) for i in kept["exact_dedup"]])
    assert set(kept["ngram_join"]) == {c for c, _ in classes.values()}

    assert set(kept["pii"]) == set(kept["ngram_join"])
    for i, text in kept["pii"].items():
        assert (text == texts[i]) or private(texts[i]) or "[IBAN]" in text or "[SSN]" in text
        assert not private(text)
    rows = docs.collect()
    check(rows)
    assert {r.doc_id for r in rows} == set(kept["pii"])


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)
    assert check(out.collect()) > 0


LONG = " ".join(f"word{i} and{i % 977}" for i in range(60_000)) + " write to long@example.org"
GOOD = "The old harbour town sleeps below the hills while small boats return with the evening tide and its fish."


def odd_rows():
    near = " ".join(f"{a}{b}" for a in ("stone", "river", "cloud", "grain", "light") for b in ("side", "work", "ward", "less", "fall", "like", "bird", "song"))
    return [
        (1, GOOD, "en", "a", 104, "x"),
        (1, GOOD, "en", "a", 104, "x"),  # a repeated row
        (2, GOOD.upper(), "en", "b", 104, "y"),  # equal but for case: a tie between ids
        (3, None, None, None, None, None),
        (None, None, "en", "a", 1, "z"),
        (4, "", "en", "a", 0, ""),
        (5, "few words", "en", "a", 9, "x"),
        (None, GOOD + " No one knows since when.", "en", "a", 129, "n"),
        (6, near, "en", "a", 300, "x"),
        (6, near + " yes", "en", "a", 304, "x"),  # a near copy under the same id
        (7, LONG, "en", "a", len(LONG), "x"),
        (8, LONG + " end", "en", "a", len(LONG) + 4, "x"),
    ]


def table(spark, rows, folder):
    """A table of documents with extra columns that stages use inside."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `quality_counts` string")
    docs = docs.selectExpr("*", "n_chars AS gone_id", "lang AS `a``b`", "source AS sequence_id")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return docs


def test_stages_take_odd_rows(spark, tmp_path):
    docs = table(spark, odd_rows(), tmp_path)
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        left[name] = sorted(docs.collect(), key=str)
    ids = lambda name: sorted([r.doc_id for r in left[name]], key=str)
    assert ids("quality_rules") == [1, 1, 2, 6, 6, 7, 8, None]  # null, empty and short texts go
    assert ids("exact_dedup") == [2, 6, 6, 7, 8, None]
    assert ids("ngram_join") == [2, 6, 7, None]
    for r in left["ngram_join"]:
        assert (r.gone_id, r.quality_counts is None) == (r.n_chars, False)
    assert ids("pii") == ids("ngram_join")
    (long,) = [r for r in left["pii"] if r.doc_id == 7]
    assert long.text.endswith("write to [EMAIL]") and len(long.text) == long.n_chars and long.text.startswith("word0 and0")
    assert check(left["packing"]) > 1 and ids("packing").count(7) > 1
    assert {r.doc_id for r in left["packing"]} == {2, 6, 7, None}


def test_an_empty_table(spark, tmp_path):
    table(spark, [], tmp_path)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "piece", "sequence_id"} <= set(out.columns)


def test_stage_folders_are_removed(spark, small):
    from pathlib import Path

    corpus_pipeline.run(spark, small)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    assert not list(Path(folder).glob("pipeline-*"))
