import pytest
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators import lookup, paging, relation, resolve, search
from citeloom.plans import workflows
from citeloom.sources.schemas import SCHEMAS
from citeloom.sources.tables import Tables, read_json, write_json, write_tables

PAPERS = [
    ("p1", "Deep nets", "深度网络", 2001, 5, "v1", [("a1", "Ann Lee", "Uni X", "o1")], ["nets"], True),
    ("p2", "100% deep_ly odd", None, None, 5, "v1", [("a2", "Bo", "Lab Y", "o2")], ["odd", "nets"], False),
    ("p3", "Shallow", None, 2003, None, "v2", [], None, None),
    ("p4", None, None, 2003, 9, None, None, [], True),
]


@pytest.fixture(scope="module")
def papers(spark):
    return spark.createDataFrame(PAPERS, "paper_id string, title string, title_zh string, year int, n_citation bigint, venue_id string, authors array<struct<author_id:string,name:string,org:string,org_id:string>>, keywords array<string>, is_sci boolean")


def ids(df, column="paper_id"):
    return [r[column] for r in df.collect()]


def test_title_search_is_literal_and_bilingual(papers):
    assert ids(search.paper_search(papers, "DEEP")) == ["p1", "p2"]
    assert ids(search.paper_search(papers, "%")) == ["p2"]
    assert ids(search.paper_search(papers, "p_l")) == ["p2"]  # its title holds it literally
    assert ids(search.paper_search(papers, "d_ep")) == ids(search.paper_search(papers, "nothing")) == []
    assert ids(search.paper_search(papers, "深度")) == ["p1"]
    assert ids(search.paper_search(papers, "deep", page_no=1, size=1)) == ["p2"]
    assert ids(search.paper_search(papers, "deep", page_no=-3, size=1)) == ["p1"]
    assert ids(search.paper_search(papers, "deep", page_no=9)) == []


def test_pro_search_predicates_order_and_ties(papers):
    assert ids(search.paper_search_pro(papers, author="lee", org="uni")) == ["p1"]
    assert ids(search.paper_search_pro(papers, keyword="net", order="n_citation")) == ["p1", "p2"]
    assert ids(search.paper_search_pro(papers, order="n_citation")) == ["p4", "p1", "p2", "p3"]
    assert ids(search.paper_search_pro(papers, order="year")) == ["p3", "p4", "p1", "p2"]
    assert ids(search.paper_search_pro(papers, title="")) == ["p1", "p2", "p3"]  # given, and a null title contains nothing
    with pytest.raises(ValueError):
        search.paper_search_pro(papers, order="size")


def test_qa_search_argument_presence(papers):
    run = lambda **k: ids(search.paper_qa_search(papers, **k))
    everything = ["p4", "p1", "p2", "p3"]
    assert run() == run(author_id=[], venue_ids=[], title=[], year=[]) == everything
    assert run(author_id=["a1"], author_terms=["bo"]) == ["p1", "p2"]
    assert run(org_id=["o2"]) == ["p2"]
    assert run(sci_flag=True) == ["p4", "p1"]
    assert run(year=[2003], force_citation_sort=True) == ["p4", "p3"]
    assert run(force_year_sort=True, size=2, offset=1) == ["p4", "p1"]
    assert run(venue_ids=["v2"]) == ["p3"]
    with pytest.raises(ValueError):
        run(force_citation_sort=True, force_year_sort=True)


def test_topics_and_queries(papers):
    hit = search.paper_qa_search(papers, use_topic=True, topic_high='[["deep", "shallow"], []]', topic_middle=[["nets"]], topic_low=[["odd"], ["deep"]])
    assert [(r.paper_id, r.score) for r in hit.collect()] == [("p1", 11.0), ("p2", 2.0), ("p3", 0.0)]
    both = search.paper_qa_search(papers, query="shallow", use_topic=True, topic_high=[["deep"]])
    assert ids(both) == ["p3"]  # a query wins
    assert ids(search.paper_qa_search(papers, use_topic=True, topic_high=[["deep"], ["odd"]])) == ["p2"]
    boosted = search.paper_qa_search(papers, query="deep", n_citation_flag=True).first()
    assert boosted.score == pytest.approx(1 + 1.791759469)


def test_one_of_three(papers):
    for bad in ({}, {"keyword": "a", "venue": "b"}):
        with pytest.raises(ValueError):
            search.paper_list_by_search_venue(papers, **bad)
    assert ids(search.paper_list_by_keywords(papers, ["ODD", "nets"])) == ["p1", "p2"]
    assert ids(search.paper_list_by_keywords(papers, ["odd", "nets"], every=True)) == ["p2"]


def test_person_search_caps_and_exact_names(spark):
    rows = [(f"s{i:02}", f"Wei {i}", "X", f"o{i % 2}", i) for i in range(15)] + [("z", "wei", "X", "o0", 0)]
    people = spark.createDataFrame(rows, "person_id string, name string, org string, org_id string, n_citation int")
    found = ids(search.person_search(people, name="wei", size=99), "person_id")
    assert len(found) == 10 and found[:2] == ["z", "s14"]
    assert len(ids(search.person_search(people, name="wei"), "person_id")) == 5
    assert ids(search.person_search(people, org_id=["o1"], size=2), "person_id") == ["s13", "s11"]
    assert ids(search.person_search(people, org_id=["o1"], size=2, offset=1), "person_id") == ["s11", "s09"]
    both = spark.createDataFrame([("a", "Wei Wang", "王伟", "Uni", "大学", 1), ("b", "Bo", None, None, None, 2)], "person_id string, name string, name_zh string, org string, org_zh string, n_citation int")
    assert ids(search.person_search(both, name="王"), "person_id") == ids(search.person_search(both, org="大学"), "person_id") == ["a"]


def test_other_names_and_misspelt_ones(spark):
    orgs = spark.createDataFrame([("o1", "Uni X", ["The X"], ["UX"]), ("o2", "Lab", None, None)], "org_id string, name string, aliases array<string>, acronyms array<string>")
    for text_ in ("uni", "the x", "ux"):
        assert ids(search.org_search(orgs, [text_]), "org_id") == ["o1"]
    venues = spark.createDataFrame([("v1", "Nature", ["Nat."]), ("v2", "Science", None)], "venue_id string, name string, alias array<string>")
    assert ids(search.venue_search(venues, "Sceince"), "venue_id") == [] and ids(search.venue_search(venues, "Sceince", errors=2), "venue_id") == ["v2"]
    assert ids(search.venue_search(venues, "nat.", errors=1), "venue_id") == ["v1"]
    papers = spark.createDataFrame([("p1", "Deep", "深度", 1), ("p2", "Flat", None, 2)], "paper_id string, title string, title_zh string, n_citation int")
    assert ids(search.paper_qa_search(papers, title=["深"])) == ["p1"]


def test_lookups(papers, spark):
    assert sorted(ids(lookup.by_keys(papers, "paper_id", ["p2", None, "p2", "x"]))) == ["p2"]
    many = [f"k{i}" for i in range(1500)] + ["p3"]
    assert ids(lookup.by_keys(papers, "paper_id", many)) == ["p3"]
    assert ids(lookup.by_keys(papers, "paper_id", [])) == []
    keys = spark.createDataFrame([("p1",), ("p1",), (None,)], "paper_id string")
    assert ids(lookup.by_frame(papers, "paper_id", keys)) == ["p1"]


def test_citations_prefix_before_filter(spark):
    cited = [(None if i % 5 == 0 else f"c{i}", "" if i == 1 else None, f"t{i}") for i in range(25)]
    cited[0] = ("", "late", "t0")
    nested = spark.createDataFrame([("p", cited), ("q", None), ("r", []), ("s", [("c", None, "a"), ("c", None, "b")])], "paper_id string, cited array<struct<_id:string,id:string,title:string>>")
    edges = relation.cited(nested)
    kept = relation.cited_prefix(edges).orderBy("paper_id", "pos").collect()
    mine = [r.cited_id for r in kept if r.paper_id == "p"]
    assert len(mine) == 17 and mine[0] == "late" and "c21" not in mine
    assert [r.cited_id for r in kept if r.paper_id == "s"] == ["c", "c"]
    assert edges.where("paper_id IN ('q', 'r')").count() == 0
    assert relation.flattened(spark.createDataFrame([(1, None), (2, [3, 4])], "k int, v array<int>"), "k", "v").count() == 2


def test_paging_bases_and_caps(spark):
    rows = spark.range(10_500).select(F.lit("o").alias("org_id"), F.col("id").alias("patent_id"))
    page = lambda n, size: ids(relation.org_patents(rows, "o", n, size), "patent_id")
    assert page(1, 3) == [0, 1, 2] == page(0, 3) and page(2, 3) == [3, 4, 5]
    assert len(page(1, 20_000)) == 10_000 and page(200, 100) == []
    people = rows.withColumnRenamed("patent_id", "person_id")
    assert ids(relation.org_page(people, "person_id", 10_495), "person_id") == [10_495, 10_496, 10_497, 10_498, 10_499]


def test_venue_years(spark):
    rows = spark.createDataFrame([("v", 1, 0), ("v", 2, 1999), ("v", 2, 1999), ("w", 3, 1999)], "venue_id string, paper_id int, year int")
    assert ids(relation.venue_papers(rows, "v")) == [1, 2]
    assert ids(relation.venue_papers(rows, "v", year=0)) == [1]
    assert ids(relation.papers_of_year(rows, 1999)) == [] and ids(relation.papers_of_year(rows, 1999, "w")) == [3]


def test_fallbacks_decide_per_key_and_as_a_whole(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    routes = ("first", "second")
    got = {(r.k, r.v, r.route) for r in resolve.with_fallback(a, b, ["k"], routes).collect()}
    assert got == {(1, "a", "first"), (2, "b", "first -> second")}
    assert {r.v for r in resolve.if_empty(a, b, routes).collect()} == {"a"}
    assert {r.v for r in resolve.if_empty(a.limit(0), b, routes).collect()} == {"b"}


def test_disambiguation(spark):
    raw = spark.createDataFrame([("Uni X", "U1", "Lab", "L1")], "`一级` string, `一级ID` string, `二级` string, `二级ID` string")
    aliases = resolve.renamed(raw).withColumn("alias_norm", text.normalised_name(F.lit("  Uni-X,  Lab ")))
    row = resolve.disambiguate_pro(aliases, ["uni x lab", "other"]).first()
    assert (row.primary_id, row.secondary_id) == ("U1", "L1")
    assert resolve.disambiguate(aliases, ["UNI X (Lab)"]).first().org_name == "Lab"


def test_values(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('[{"k": 2}, {"k": 3}]',), ("[]",), (None,), ("{bad",)], "v string")
    assert [r[0] for r in df.select(text.object_or_list(F.col("v"), "struct<k:int>")["k"]).collect()] == [1, 2, None, None, None]
    cases = {"abc": ["abc"], '"abc"': ["abc"], '["a","b"]': ["a", "b"], "123": ["123"], "{}": ["{}"], '""': ['""'], '" x "': ["x"], '"  "': ['"  "'], "\ty\n": ["y"], "  ": None, "": None}
    lists = spark.createDataFrame([(k,) for k in cases], "v string").select("v", text.id_list(F.col("v")).alias("ids")).collect()
    assert {r.v: r.ids for r in lists} == cases
    for k, v in cases.items():
        assert text.parse_ids(k) == v
    assert text.parse_ids(["x"]) == ["x"] and text.parse_ids([]) is None and text.parse_ids(None) is None
    row = spark.range(1).select(text.first_given(F.lit(""), F.lit(None).cast("string"), F.lit("c")).alias("a"), text.link("paper", F.lit(None).cast("string")).alias("b")).first()
    assert row.a == "c" and row.b is None


def test_tables_json_and_parquet(spark, tmp_path):
    t = Tables(spark, frames={"venue": spark.createDataFrame([("v1", "Ä", None, None, None, None, ["x"], None)], SCHEMAS["venue"])})
    write_json(t["venue"], str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j"), "venue").first().name == "Ä"
    write_tables(t, str(tmp_path / "t"), ["venue", "paper"])
    again = Tables(spark, str(tmp_path / "t"))
    assert again["venue"].count() == 1 and again["paper"].count() == 0
    with pytest.raises(KeyError):
        again["nothing"]


def test_deep_dive_takes_the_fallback(spark, papers):
    edges = spark.createDataFrame([("p2", i, f"c{i}" if i != 3 else None) for i in range(25)], "paper_id string, pos int, cited_id string")
    cited = spark.createDataFrame([(f"c{i}",) for i in range(30)], "cited_paper_id string")
    full = ["paper_detail", "paper_relation", "paper_info"]
    r = workflows.paper_deep_dive(papers, edges, cited, "cited_paper_id", keyword="odd")
    assert r["selected"].first().paper_id == "p2" and r["references_count"].first().total == 25
    assert r["references_preview"].count() == 10 and r["cited_papers_info"].count() == 19
    assert r.status == {"odd": "ok"} and r.chain == {"odd": ["paper_search_pro", *full]}
    r = workflows.paper_deep_dive(papers, edges, cited, "cited_paper_id", title="deep")
    assert r["selected"].first().route == "paper_search" and r.chain == {"deep": ["paper_search", *full[:2]]}  # p1 cites nothing
    more = papers.where("paper_id <> 'p4'").unionByName(papers.where("paper_id = 'p4'").withColumn("keywords", F.array(F.lit("Graphs"), F.lit("odd"))))
    more = more.withColumn("keywords", F.when(F.col("paper_id") == "p2", F.array(F.lit("graphs"))).otherwise(F.col("keywords")))
    r = workflows.paper_deep_dive(more, edges, cited, "cited_paper_id", title="graph")
    assert ids(r["search_candidates"].orderBy("ordinal")) == ["p4", "p2"]  # only their keywords fit; the more cited first
    assert r["selected"].first().route == "paper_search -> paper_search_pro"
    assert r.chain == {"graph": ["paper_search", "paper_search_pro", *full[:2]]}
    none = workflows.paper_deep_dive(papers, edges, cited, "cited_paper_id", title="absent")
    assert none["selected"].count() == none["references_count"].count() == 0
    assert none.status == {"absent": "not_found"} and none.chain == {"absent": ["paper_search", "paper_search_pro"]}
    with pytest.raises(ValueError):
        workflows.paper_deep_dive(papers, edges, cited, "cited_paper_id")


def test_ranked_and_window(papers):
    top = paging.ranked(papers, ["venue_id"], paging.by("n_citation", "paper_id"), 1)
    assert {r.paper_id for r in top.collect()} == {"p1", "p3", "p4"}
