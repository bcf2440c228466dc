"""Extra columns whose names the operators use for themselves, or that need quoting."""

import pytest
from pyspark.sql import functions as F

from citeloom.llm import byte_bpe, exact_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, secrets, toxicity, url_filter
from citeloom.llm.common import unused

GOOD = "A plain text of a dozen common words, which no rule has reason to doubt."
#: Names that operators use inside, in their results, or as helpers, and odd ones.
NAMES = (
    "__q __w __l __g __p __bar __kept __id __row __len __text __full __hash __more __map __bits __shared __prefix __best __gone __vague __stay __key __pii __nth __salt __own __start __number __n "
    "words lines windows quality_counts gone_id vague_id text_hash least_row set_key stay_id stay_key pii_found rid key size bands node root copies class class_id copy_id "
    "kept keep_id group_size score label predicted held_out ids decoded piece start length sequence_id offset spans host path rule verdict globs"
).split() + ["a`b", "a.b", "a b", "`", "Größe", "__Q", "GONE_ID"]
ROWS = [(1, GOOD, 73), (2, GOOD + " And a mail to me@example.org here.", 108), (None, None, None), (4, "", 0), (4, GOOD, 73), (4, GOOD, 73)]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, n_chars long")
    low = {"__Q", "GONE_ID"}
    return plain.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES if n not in low])


def values(row):
    """The extra columns, each of which tells its own name and the row's id."""
    d = row.asDict()
    i = "-" if d["doc_id"] is None else d["doc_id"]
    return all(d[n] == f"{n}:{i}" for n in NAMES if n in d)


@pytest.mark.parametrize(
    ("stage", "ids"),
    [
        (quality_rules.keep_good, [1, 2, 4, 4]),
        (exact_dedup.keep_distinct, [2, 4, 4]),
        (ngram_join.keep_one_of_each, ["-", 1, 2, 4]),
        (pii.redact, ["-", 1, 2, 4, 4, 4]),
    ],
)
def test_stages_keep_all_columns(docs, stage, ids):
    out = stage(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert all(map(values, rows))
    got = sorted(["-" if r.doc_id is None else r.doc_id for r in rows], key=str)
    if stage is exact_dedup.keep_distinct:  # a null and an empty text are equal, and the larger id stays
        assert got == [2, 4, 4] and {(r.doc_id, r.text) for r in rows} == {(2, ROWS[1][1]), (4, GOOD), (4, "")}
    elif stage is ngram_join.keep_one_of_each:
        assert {r.doc_id for r in rows if r.text == GOOD} == {1} and len([r for r in rows if not r.text]) == 2
    else:
        assert got == sorted(ids, key=str)
    assert stage(docs.where("false")).columns == docs.columns and stage(docs.where("false")).count() == 0


@pytest.mark.parametrize("operator", [secrets.find_secrets, byte_bpe.encode, packing.pack, exact_dedup.duplicate_groups, ngram_join.link_documents])
def test_results_do_not_depend_on_extra_columns(docs, operator):
    plain = docs.select("doc_id", "text")
    shape = lambda df: sorted(str(r.asDict()) for r in df.drop("sequence_id", "offset").collect())
    assert shape(operator(docs)) == shape(operator(plain)) and len(shape(plain)) == 6


def test_classifiers_and_urls_with_extra_columns(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (quality_classifier, toxicity):
        assert {r.score for r in module.score(docs, module.fit(docs, labels)).collect()} == {0.5}
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://com/en/").alias("url"), *[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns[3:]])
    assert {r.verdict for r in url_filter.url_verdicts(pages).collect()} == {"block"}
    assert pii.find_pii(docs, out="spans").columns == docs.columns


def test_unused_names():
    class Frame:
        columns = ("A", "_a", "b")

    assert unused(Frame, "a", "c", "c", "B") == ["__a", "c", "_c", "_B"]
