"""Every operator and workflow as a query on the test tables, with the same in SQL.

The tables hold no scholarly data; `sources.standin` says what stands for what.
Workflows give long rows (query, section, ordinal, entity_id, label, metric).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators import lookup, paging, relation, resolve, search
from citeloom.plans import costs, workflows
from citeloom.sources.standin import StandIn

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MIDDLE = [["attion"], ["thble", "erly"]]
LOW = [["shor"], ["onti"]]
HIGH = [["the", "und"], ["en", "er"]]


def query(sql: str):
    """Register a function of StandIn under its name, with its SQL."""

    def add(fn: Callable[[StandIn], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(StandIn(spark, sf_dir))
        ORACLES[fn.__name__] = sql
        return fn

    return add


def long(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("bigint"))


# --- papers ---------------------------------------------------------------------------------


@query("SELECT doc_id AS paper_id, text AS title FROM documents WHERE contains(lower(text), 'the') ORDER BY doc_id LIMIT 10")
def f01_paper_search(s):
    return search.paper_search(s.text_papers(), "the")


@query("SELECT doc_id AS paper_id, source AS venue_name, n_chars AS n_citation FROM documents WHERE contains(lower(text), 'the') AND contains(lower(source), 'src0') ORDER BY n_chars DESC, doc_id LIMIT 5 OFFSET 5")
def f02_paper_search_pro(s):
    return search.paper_search_pro(s.text_papers(), title="the", venue="src0", order="n_citation", page_no=1, size=5).select("paper_id", "venue_name", "n_citation")


_hit = lambda t: f"contains(lower(text), '{t}')"
_any = lambda ts: "(" + " OR ".join(map(_hit, ts)) + ")"
_sum = lambda gs: " + ".join(f"CAST({_any(g)} AS INT)" for g in gs)


@query(
    f"""SELECT d.doc_id AS paper_id, CAST(10 * ({_sum(MIDDLE)}) + ({_sum(LOW)}) AS DOUBLE) AS score, n_chars AS n_citation
    FROM documents d WHERE {" AND ".join(map(_any, HIGH))} AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
    ORDER BY score DESC, n_chars DESC, doc_id LIMIT 10"""
)
def f03_topic(s):
    out = search.paper_qa_search(s.sci_papers(), use_topic=True, topic_high=HIGH, topic_middle=MIDDLE, topic_low=LOW, sci_flag=True)
    return out.select("paper_id", "score", "n_citation")


@query(
    f"""SELECT doc_id AS paper_id, CAST({_sum([["the"], ["attion"], ["thble"]])} AS DOUBLE) AS score, n_chars AS n_citation
    FROM documents WHERE {_any(["the", "attion", "thble"])} ORDER BY score DESC, n_chars DESC, doc_id LIMIT 10"""
)
def f03_query(s):
    return search.paper_qa_search(s.text_papers(), query="the attion THBLE the").select("paper_id", "score", "n_citation")


_AUTHORED = """SELECT o_orderkey AS paper_id, o_custkey AS author_id, CAST(year(o_orderdate) AS BIGINT) AS year, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS n_citation
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _authored(df: DataFrame) -> DataFrame:
    return long(df, "year").select("paper_id", F.col("person_id").alias("author_id"), "year", "date", "n_citation")


@query(f"{_AUTHORED} WHERE (o_custkey IN (1, 3, 5) OR contains(lower(c_name), '00000012')) AND year(o_orderdate) IN (1996, 1997, 1998) ORDER BY o_totalprice DESC, o_orderkey LIMIT 5 OFFSET 5")
def f03_filters(s):
    return _authored(search.paper_qa_search(s.authored_papers(), author_id=[1, 3, 5], author_terms=["00000012"], year=[1996, 1997, 1998], force_citation_sort=True, offset=5, size=5))


@query(f"{_AUTHORED} WHERE (n_nationkey IN (3) OR contains(lower(n_name), 'nation_4')) ORDER BY year(o_orderdate) DESC, o_orderkey LIMIT 5")
def f03_year_sort(s):
    return _authored(search.paper_qa_search(s.authored_papers(), org_id=[3], org_terms=["NATION_4"], force_year_sort=True, size=5))


@query("SELECT doc_id AS paper_id, round(2 + ln(1 + n_chars), 6) AS score FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'er') AND source IN ('src0', 'src1') ORDER BY 2 + ln(1 + n_chars) DESC, n_chars DESC, doc_id LIMIT 8")
def f03_citation_boost(s):
    both = s.text_papers().where(text.contains(F.col("title"), "the") & text.contains(F.col("title"), "er"))
    out = search.paper_qa_search(both, query="the er", venue_ids=["src0", "src1"], n_citation_flag=True, size=8)
    return out.select("paper_id", F.round("score", 6).alias("score"))


@query("SELECT o_orderkey AS paper_id, o_orderpriority AS title, o_totalprice AS n_citation FROM orders WHERE o_orderkey IN (1, 5, 7, 100, 900000000)")
def f04_paper_info(s):
    return lookup.by_keys(s.papers(), "paper_id", [1, 5, 5, None, 7, 100, 900000000], ["paper_id", "title", "n_citation"])


@query("SELECT o_orderkey AS paper_id, c_name AS name, n_name AS org, o_totalprice AS n_citation, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey = 42")
def f05_paper_detail(s):
    return lookup.by_key(s.authored_papers(), "paper_id", 42, ["paper_id", "name", "org", "n_citation", "date"])


_EDGES = "SELECT l_orderkey AS paper_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS pos, CAST(l_partkey AS VARCHAR) AS cited_id FROM lineitem"


@query(f"SELECT paper_id, CAST(pos AS BIGINT) AS pos, cited_id FROM ({_EDGES})")
def f06_paper_relation(s):
    return long(relation.cited(s.citations()).select("paper_id", "pos", "cited_id"), "pos")


@query("SELECT o_orderkey AS paper_id, o_totalprice AS n_citation FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 10")
def f08_keyword_list(s):
    return search.paper_list_by_keywords(s.keyword_papers(), ["PARTIAL", "part"]).select("paper_id", "n_citation")


@query("SELECT doc_id AS paper_id, source AS venue_name, lang, n_chars AS n_citation FROM documents WHERE contains(lower(source), 'src3') ORDER BY n_chars DESC, doc_id LIMIT 10")
def f07_paper_list_by_search_venue(s):
    return search.paper_list_by_search_venue(s.text_papers(), venue="src3", order="n_citation").select("paper_id", "venue_name", "lang", "n_citation")


@query(f"SELECT doc_id AS paper_id, lang FROM documents WHERE {_any(['attion', 'thble'])} ORDER BY doc_id LIMIT 10 OFFSET 10")
def f08_paper_list_by_keywords(s):
    return search.paper_list_by_keywords(s.text_papers(), ["attion", "thble"], page_no=1, column="title").select("paper_id", "lang")


@query("SELECT DISTINCT l_orderkey AS paper_id FROM lineitem WHERE l_suppkey = 1 AND year(l_shipdate) = 1996")
def f09_paper_detail_by_condition(s):
    return relation.papers_of_year(s.venue_paper(), 1996, 1)


# --- scholars -------------------------------------------------------------------------------

_SCHOLARS = "SELECT c_custkey AS person_id, c_name AS name, n_name AS org, c_acctbal AS n_citation FROM customer JOIN nation ON c_nationkey = n_nationkey"


def _scholar(df: DataFrame) -> DataFrame:
    return df.select("person_id", "name", "org", "n_citation")


@query(f"{_SCHOLARS} WHERE contains(lower(c_name), 'customer#0000000') AND contains(lower(n_name), 'nation') AND n_nationkey IN (3, 4, 5) ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def f10_person_search(s):
    return _scholar(search.person_search(s.scholars(), name="customer#0000000", org="nation", org_id=[3, 4, 5], size=50))


@query(f"{_SCHOLARS} WHERE contains(lower(c_name), 'customer#0000000') ORDER BY c_acctbal DESC, c_custkey LIMIT 5 OFFSET 7")
def f10_from_an_offset(s):
    return _scholar(search.person_search(s.scholars(), name="customer#0000000", offset=7))


@query("SELECT c_custkey AS person_id, c_name AS name, n_name AS org, c_acctbal AS n_citation, c_mktsegment AS domain FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 3")
def f11_person_detail(s):
    return lookup.by_key(s.scholars(), "person_id", 3, ["person_id", "name", "org", "n_citation", "domain"])


@query("SELECT DISTINCT user_id AS person_id, event_type AS interest FROM events WHERE user_id = 5")
def f12_person_figure(s):
    return lookup.by_key(s.figures(), "person_id", 5)


@query("SELECT o_custkey AS person_id, o_orderkey AS paper_id, o_orderpriority AS title FROM orders WHERE o_custkey = 3")
def f13_person_paper_relation(s):
    return relation.held_by(s.scholar_paper(), "person_id", 3).select("person_id", "paper_id", "title")


@query("SELECT DISTINCT p_partkey AS patent_id, p_name AS title FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE o_custkey = 5")
def f14_person_patent_relation(s):
    held = relation.held_by(s.scholar_patent(), "person_id", 5)
    return lookup.by_frame(s.patents(), "patent_id", held).select("patent_id", "title")


@query("SELECT event_id AS project_id, event_type AS titles, value AS fund_amount, strftime(ts, '%Y-%m-%d') AS start_date FROM events WHERE user_id = 5")
def f15_person_project(s):
    return relation.held_by(s.projects(), "person_id", 5).drop("person_id")


# --- institutions ---------------------------------------------------------------------------

_ORGS = "SELECT CAST(n_nationkey AS BIGINT) AS org_id, n_name AS name, r_name AS parent_name FROM nation JOIN region ON n_regionkey = r_regionkey"


def _org(df: DataFrame) -> DataFrame:
    return long(df, "org_id").select("org_id", "name", "parent_name")


@query(f"{_ORGS} WHERE contains(lower(n_name), 'nation_1') OR contains(lower(n_name), 'n_2')")
def f16_org_search(s):
    return _org(search.org_search(s.orgs(), ["NATION_1", "n_2"]))


@query(f"{_ORGS} WHERE n_nationkey IN (3, 7, 11)")
def f17_org_detail(s):
    return _org(lookup.by_keys(s.orgs(), "org_id", [3, 7, 11, 99]))


@query(f"{_SCHOLARS} WHERE n_nationkey = 3 ORDER BY c_custkey LIMIT 10 OFFSET 10")
def f18_org_person_relation(s):
    return _scholar(relation.org_page(relation.held_by(s.scholars(), "org_id", 3), "person_id", 10))


@query("SELECT o_orderkey AS paper_id, o_orderpriority AS title FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) ORDER BY o_orderkey LIMIT 10")
def f19_org_paper_relation(s):
    return relation.org_page(relation.org_papers(s.papers().select("paper_id", "title"), s.scholar_paper(), s.scholars(), 3), "paper_id")


@query("SELECT DISTINCT l_partkey AS patent_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey = 3 ORDER BY l_partkey LIMIT 100 OFFSET 100")
def f20_org_patent_relation(s):
    return relation.org_patents(s.org_patent(), 3, page_no=2, page_size=100)


_ALIASES = """SELECT q.query, CAST(r_regionkey AS BIGINT) AS primary_id, r_name AS primary_name, CAST(n_nationkey AS BIGINT) AS secondary_id, n_name AS secondary_name
    FROM (VALUES ('Nation 3', 'nation 3'), ('  NATION-7', 'nation 7'), ('nowhere', 'nowhere')) q(query, norm)
    JOIN nation ON lower(replace(n_name, '_', ' ')) = q.norm JOIN region ON n_regionkey = r_regionkey"""
_NAMES = ["Nation 3", "  NATION-7", "nowhere"]


@query(f"SELECT query, secondary_name AS org_name FROM ({_ALIASES})")
def f21_org_disambiguate(s):
    return resolve.disambiguate(s.aliases(), _NAMES)


@query(_ALIASES)
def f22_org_disambiguate_pro(s):
    return long(long(resolve.disambiguate_pro(s.aliases(), _NAMES), "primary_id"), "secondary_id")


# --- venues and patents ---------------------------------------------------------------------


@query("SELECT s_suppkey AS venue_id, s_name AS name, CAST(levenshtein(lower(s_name), 'supplier#00000000') AS BIGINT) AS distance FROM supplier WHERE contains(lower(s_name), 'supplier#00000000')")
def f23_venue_search(s):
    return long(search.venue_search(s.venues(), "Supplier#00000000"), "distance").select("venue_id", "name", "distance")


@query("SELECT s_suppkey AS venue_id, s_name AS name, CAST(levenshtein(lower(s_name), 'suplier#000000012') AS BIGINT) AS distance FROM supplier WHERE levenshtein(lower(s_name), 'suplier#000000012') <= 2")
def f23_misspelt_venue(s):
    return long(search.venue_search(s.venues(), "Suplier#000000012", errors=2), "distance").select("venue_id", "name", "distance")


@query("SELECT s_suppkey AS venue_id, s_name AS name, n_name AS org, s_acctbal AS n_citation FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey = 1")
def f24_venue_detail(s):
    orgs = s.orgs().select("org_id", F.col("name").alias("org"))
    return lookup.by_key(s.venues().join(orgs, "org_id"), "venue_id", 1, ["venue_id", "name", "org", "n_citation"])


@query(
    """(SELECT DISTINCT 'of 1996' AS part, l_orderkey AS paper_id FROM lineitem WHERE l_suppkey = 1 AND year(l_shipdate) = 1996 ORDER BY paper_id LIMIT 20)
    UNION ALL (SELECT DISTINCT 'all', l_orderkey FROM lineitem WHERE l_suppkey = 1 ORDER BY l_orderkey LIMIT 20 OFFSET 20)"""
)
def f25_venue_paper_relation(s):
    a = relation.venue_papers(s.venue_paper(), 1, year=1996).select(F.lit("of 1996").alias("part"), "paper_id")
    return a.unionByName(relation.venue_papers(s.venue_paper(), 1, offset=20).select(F.lit("all").alias("part"), "paper_id"))


@query("SELECT p_partkey AS patent_id, p_name AS title FROM part WHERE contains(lower(p_name), 'gear') ORDER BY p_partkey LIMIT 10 OFFSET 10")
def f26_patent_search(s):
    return search.patent_search(s.patents(), "GEAR", page_no=1).select("patent_id", "title")


@query("SELECT p_partkey AS patent_id, p_name AS title FROM part WHERE p_partkey = 17")
def f27_patent_info(s):
    return lookup.by_key(s.patents(), "patent_id", 17, ["patent_id", "title"])


@query("SELECT p_partkey AS patent_id, p_name AS title, p_brand AS assignee, p_type AS pub_kind, CAST(p_size AS BIGINT) AS sequence, p_retailprice AS price FROM part WHERE p_partkey = 17")
def f28_patent_detail(s):
    return long(lookup.by_key(s.patents(), "patent_id", 17), "sequence")


# --- workflows ------------------------------------------------------------------------------

#: id, label and metric of each section.
_PERSON, _PAPER, _PATENT = ("person_id", "name", "n_citation"), ("paper_id", None, None), ("patent_id", None, None)
_TOTAL = (None, None, "total")


def _rows(section: str, source: str, ordinal: str = "1", key: str = "NULL", label: str = "NULL", metric: str = "NULL", q: str = "query") -> str:
    return f"SELECT {q} AS query, '{section}' AS section, CAST({ordinal} AS BIGINT) AS ordinal, CAST({key} AS VARCHAR) AS entity_id, CAST({label} AS VARCHAR) AS label, CAST({metric} AS DOUBLE) AS metric FROM {source}"


def _top(source: str, key: str, most: int) -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY query ORDER BY {key}) AS ordinal FROM {source} QUALIFY ordinal <= {most})"


def _match(source: str, name: str, key: str, cite: str | None, names: list[str], most: int) -> str:
    values = ", ".join(f"('{n}')" for n in names)
    order = f"(lower({name}) = lower(query)) DESC, " + (f"{cite} DESC NULLS LAST, " if cite else "") + key
    return f"(SELECT q.query, t.*, row_number() OVER (PARTITION BY query ORDER BY {order}) AS ordinal FROM (VALUES {values}) q(query) JOIN {source} t ON contains(lower({name}), lower(q.query)) QUALIFY ordinal <= {most})"


_W1 = ["Customer#000000001", "customer#00000000", "nobody"]


@query(
    f"""WITH found AS {_match("customer", "c_name", "c_custkey", "c_acctbal", _W1, 5)}, one AS (SELECT query, c_custkey AS person_id FROM found WHERE ordinal = 1),
    papers AS (SELECT query, o_orderkey AS paper_id, o_orderpriority AS title, o_totalprice FROM orders JOIN one ON o_custkey = person_id),
    patents AS (SELECT DISTINCT query, l_partkey AS patent_id FROM papers JOIN lineitem ON l_orderkey = paper_id),
    figures AS (SELECT DISTINCT query, event_type FROM events JOIN one ON user_id = person_id),
    projects AS (SELECT query, events.* FROM events JOIN one ON user_id = person_id)
    {_rows("search_candidates", "found WHERE ordinal <= 3", "ordinal", "c_custkey", "c_name", "c_acctbal")}
    UNION ALL {_rows("selected", "found WHERE ordinal = 1", "ordinal", "c_custkey", "c_name", "c_acctbal")}
    UNION ALL {_rows("detail", "found WHERE ordinal = 1", "1", "c_custkey", "c_mktsegment", "c_acctbal")}
    UNION ALL {_rows("figure", _top("figures", "event_type", 10**9), "ordinal", "NULL", "event_type")}
    UNION ALL {_rows("papers", _top("papers", "paper_id", 20), "ordinal", "paper_id", "title", "o_totalprice")}
    UNION ALL {_rows("papers_total", "papers GROUP BY query", metric="count(*)")}
    UNION ALL {_rows("patents", _top("patents", "patent_id", 10), "ordinal", "patent_id")}
    UNION ALL {_rows("projects", _top("projects", "event_id", 10), "ordinal", "event_id", "event_type", "value")}"""
)
def w1_scholar_profile(s):
    r = workflows.scholar_profile(s.scholars(), s.figures(), s.scholar_paper(), s.scholar_patent(), s.projects(), _W1)
    return r.long({"search_candidates": _PERSON, "selected": _PERSON, "detail": ("person_id", "domain", "n_citation"), "figure": (None, "interest", None), "papers": ("paper_id", "title", "n_citation"), "papers_total": _TOTAL, "patents": _PATENT, "projects": ("project_id", "titles", "fund_amount")})


def _deep(hits: str, order: str, label: str) -> str:
    return f"""WITH found AS (SELECT '{label}' AS query, *, row_number() OVER (ORDER BY {order}) AS ordinal FROM {hits} QUALIFY ordinal <= 5),
    one AS (SELECT query, o_orderkey AS paper_id FROM found WHERE ordinal = 1),
    theirs AS (SELECT query, pos, cited_id FROM ({_EDGES}) e JOIN one USING (paper_id)),
    info AS (SELECT DISTINCT query, p_partkey, p_name, p_retailprice FROM theirs JOIN part ON CAST(p_partkey AS VARCHAR) = cited_id WHERE pos < 20)
    {_rows("search_candidates", "found", "ordinal", "o_orderkey", "o_orderpriority", "o_totalprice")}
    UNION ALL {_rows("selected", "found WHERE ordinal = 1", "ordinal", "o_orderkey", "o_orderpriority", "o_totalprice")}
    UNION ALL {_rows("detail", "found WHERE ordinal = 1", "1", "o_orderkey", "strftime(o_orderdate, '%Y-%m-%d')", "o_totalprice")}
    UNION ALL {_rows("references_count", "theirs GROUP BY query", metric="count(*)")}
    UNION ALL {_rows("references_preview", "theirs WHERE pos < 10", "pos + 1", "cited_id")}
    UNION ALL {_rows("cited_papers_info", _top("info", "p_partkey", 20), "ordinal", "p_partkey", "p_name", "p_retailprice")}"""


def _dive(s: StandIn, papers: DataFrame, **params) -> DataFrame:
    parts = s.patents().select(F.col("patent_id").alias("cited_paper_id"), F.col("title").alias("cited_title"), "price")
    r = workflows.paper_deep_dive(papers, s.edges, parts.withColumn("cited_paper_id", F.col("cited_paper_id").cast("string")), "cited_paper_id", **params)
    info = r.sections["cited_papers_info"]
    r.sections["cited_papers_info"] = paging.ranked(info.withColumn("number", F.col("cited_paper_id").cast("bigint")), ["query"], [F.asc("number")], 20)
    paper = ("paper_id", "title", "n_citation")
    return r.long({"search_candidates": paper, "selected": paper, "detail": ("paper_id", "date", "n_citation"), "references_count": _TOTAL, "references_preview": ("cited_id", None, None), "cited_papers_info": ("cited_paper_id", "cited_title", "price")})


@query(_deep("orders WHERE contains(lower(o_orderpriority), 'urgent')", "o_orderkey", "urgent"))
def w2_paper_deep_dive(s):
    return _dive(s, s.papers(), title="urgent")


@query(_deep("(SELECT orders.* FROM orders JOIN customer ON o_custkey = c_custkey WHERE contains(lower(o_orderpriority), 'high') AND contains(lower(c_name), '#00000000'))", "o_totalprice DESC, o_orderkey", "high"))
def w2_deep_dive_by_author(s):
    return _dive(s, s.authored_papers(), title="high", author="#00000000")


@query(_deep("orders WHERE o_orderstatus = 'P'", "o_totalprice DESC, o_orderkey", "partial"))
def w2_fallback(s):
    """No title holds the text, but keywords do; the most cited comes first."""
    return _dive(s, s.keyword_papers(), title="partial")


_W3 = ["Nation 3", "nation_1"]


@query(
    f"""WITH pro AS (SELECT 'Nation 3' AS query, n_nationkey AS org_id FROM nation WHERE lower(replace(n_name, '_', ' ')) IN ('nation 3')
      UNION ALL SELECT 'nation_1', n_nationkey FROM nation WHERE lower(replace(n_name, '_', ' ')) IN ('nation 1')),
    found AS (SELECT query, org_id, 'org_disambiguate_pro' AS route FROM pro
      UNION ALL SELECT query, n_nationkey, 'org_disambiguate_pro -> org_search' FROM {_match("nation", "n_name", "n_nationkey", None, [*_W3, "tion_24"], 1)} WHERE query NOT IN (SELECT query FROM pro)),
    people AS (SELECT query, c_custkey AS person_id, c_name AS name FROM customer JOIN found ON c_nationkey = org_id),
    papers AS (SELECT DISTINCT query, o_orderkey AS paper_id FROM orders JOIN people ON o_custkey = person_id),
    patents AS (SELECT DISTINCT query, l_partkey AS patent_id FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN found ON s_nationkey = org_id)
    {_rows("org", "found", "1", "org_id", "route")}
    UNION ALL {_rows("detail", "found JOIN nation ON n_nationkey = org_id", "1", "org_id", "n_name")}
    UNION ALL {_rows("scholars", _top("people", "person_id", 10), "ordinal", "person_id", "name")}
    UNION ALL {_rows("scholars_total", "people GROUP BY query", metric="count(*)")}
    UNION ALL {_rows("papers", _top("papers", "paper_id", 10), "ordinal", "paper_id")}
    UNION ALL {_rows("papers_total", "papers GROUP BY query", metric="count(*)")}
    UNION ALL {_rows("patents", _top("patents", "patent_id", 100), "ordinal", "patent_id")}
    UNION ALL {_rows("patents_total", "patents GROUP BY query", metric="count(*)")}"""
)
def w3_org_analysis(s):
    # here the nations are the institutions; their regions would be the primary ones
    aliases = s.aliases().withColumn("primary_id", F.lit(None).cast("int"))
    r = workflows.org_analysis(s.orgs(), aliases, s.scholars(), s.scholar_paper(), s.org_patent(), [*_W3, "tion_24"])
    return r.long({"org": ("org_id", "route", None), "detail": ("org_id", "name", None), "scholars": ("person_id", "name", None), "scholars_total": _TOTAL, "papers": _PAPER, "papers_total": _TOTAL, "patents": _PATENT, "patents_total": _TOTAL})


@query(
    f"""WITH found AS (SELECT q.query, n_regionkey AS org_id FROM (VALUES ('Nation 3', 'NATION_3'), ('NATION-7', 'NATION_7')) q(query, name) JOIN nation ON n_name = q.name
      UNION ALL SELECT 'asi', r_regionkey FROM region WHERE r_name = 'ASIA'),
    people AS (SELECT query, c_custkey AS person_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN found ON n_regionkey = org_id)
    {_rows("org", "found", "1", "org_id", "CASE WHEN query = 'asi' THEN 'org_disambiguate_pro -> org_search' ELSE 'org_disambiguate_pro' END")}
    UNION ALL {_rows("detail", "found JOIN region ON r_regionkey = org_id", "1", "org_id", "r_name")}
    UNION ALL {_rows("scholars_total", "people GROUP BY query", metric="count(*)")}"""
)
def w3_primary_first(s):
    """Regions are the institutions: the primary id wins over the secondary, and a region's own name is found by search."""
    regions = s.raw("region").select(F.col("r_regionkey").alias("org_id"), F.col("r_name").alias("name"))
    scholars = s.scholars().drop("org_id").withColumnRenamed("region_id", "org_id")
    r = workflows.org_analysis(regions, s.aliases(), scholars, s.scholar_paper(), s.org_patent(), ["Nation 3", "NATION-7", "asi"])
    r.sections = {k: r[k] for k in ("org", "detail", "scholars_total")}
    return r.long({"org": ("org_id", "route", None), "detail": ("org_id", "name", None), "scholars_total": _TOTAL})


_W4 = ["supplier#000000001", "#00000000"]


@query(
    f"""WITH found AS {_match("supplier", "s_name", "s_suppkey", None, _W4, 3)}, one AS (SELECT query, s_suppkey FROM found WHERE ordinal = 1),
    papers AS (SELECT DISTINCT query, l_orderkey AS paper_id FROM lineitem JOIN one ON l_suppkey = s_suppkey WHERE year(l_shipdate) = 1996)
    {_rows("search_candidates", "found", "ordinal", "s_suppkey", "s_name")}
    UNION ALL {_rows("venue_detail", "found WHERE ordinal = 1", "1", "s_suppkey", "s_name", "s_acctbal")}
    UNION ALL {_rows("papers", _top("papers", "paper_id", 20), "ordinal", "paper_id")}
    UNION ALL {_rows("papers_total", "papers GROUP BY query", metric="count(*)")}"""
)
def w4_venue_papers(s):
    r = workflows.venue_papers(s.venues(), s.venue_paper(), _W4, year=1996)
    return r.long({"search_candidates": ("venue_id", "name", None), "venue_detail": ("venue_id", "name", "n_citation"), "papers": _PAPER, "papers_total": _TOTAL})


@query(f"SELECT doc_id AS paper_id, CAST({_sum([['thble'], ['attion']])} AS DOUBLE) AS score, 'paper_qa_search' AS route FROM documents WHERE {_any(['thble', 'attion'])} AND source IN ('src0', 'src1') ORDER BY n_chars DESC, doc_id LIMIT 10")
def w5_paper_qa(s):
    return workflows.paper_qa(s.text_papers(), query="thble attion", venue_ids=["src0", "src1"], sort_citation=True).select("paper_id", "score", "route")


@query("SELECT doc_id AS paper_id, CAST(0 AS DOUBLE) AS score, 'paper_qa_search -> paper_search_pro' AS route FROM documents WHERE contains(lower(text), 'the') ORDER BY n_chars DESC, doc_id LIMIT 10")
def w5_paper_qa_fallback(s):
    return workflows.paper_qa(s.text_papers(), query="the", venue_ids=["no such venue"]).select("paper_id", "score", "route")


@query(
    f"""WITH hits AS (SELECT 'red' AS query, * FROM part WHERE contains(lower(p_name), 'red')),
    shown AS (SELECT *, row_number() OVER (ORDER BY p_partkey) AS ordinal FROM (SELECT * FROM hits ORDER BY p_partkey LIMIT 10 OFFSET 10))
    {_rows("search_results", "shown", "ordinal", "p_partkey", "p_name")} UNION ALL {_rows("total", "hits GROUP BY query", metric="count(*)")}
    UNION ALL {_rows("n_returned", "shown GROUP BY query", metric="count(*)")} UNION ALL {_rows("details", "shown WHERE ordinal <= 3", "ordinal", "p_partkey", "p_brand", "p_retailprice")}"""
)
def w6_patent_search(s):
    r = workflows.patent_details(s.patents(), "red", page_no=1)
    return r.long({"search_results": ("patent_id", "title", None), "total": _TOTAL, "n_returned": _TOTAL, "details": ("patent_id", "assignee", "price")})


@query(
    f"""WITH found AS {_match("customer", "c_name", "c_custkey", "c_acctbal", _W1, 3)}, one AS (SELECT query, c_custkey AS person_id FROM found WHERE ordinal = 1),
    held AS (SELECT DISTINCT query, l_partkey AS patent_id FROM orders JOIN one ON o_custkey = person_id JOIN lineitem ON l_orderkey = o_orderkey)
    {_rows("scholar", "found WHERE ordinal = 1", "ordinal", "c_custkey", "c_name", "c_acctbal")} UNION ALL {_rows("patents_list", "held", "0", "patent_id")}
    UNION ALL {_rows("patent_details", _top("held", "patent_id", 3) + " JOIN part ON p_partkey = patent_id", "ordinal", "patent_id", "p_name", "p_retailprice")}"""
)
def w7_scholar_patents(s):
    r = workflows.scholar_patents(s.scholars(), s.scholar_patent(), s.patents(), _W1)
    return r.long({"scholar": _PERSON, "patents_list": _PATENT, "patent_details": ("patent_id", "title", "price")})


# --- dataflow operators ---------------------------------------------------------------------


@query(f"SELECT query, c_custkey AS person_id, c_name AS name FROM {_match('customer', 'c_name', 'c_custkey', 'c_acctbal', _W1, 1)}")
def d01_pick_first(s):
    return search.match_names(s.scholars(), "name", _W1, "person_id", "n_citation", 1).select("query", "person_id", "name")


@query("SELECT o_custkey AS person_id, o_orderkey AS paper_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS ordinal FROM orders QUALIFY ordinal <= 3")
def d02_top_n(s):
    return long(paging.ranked(s.scholar_paper(), ["person_id"], paging.by("n_citation", "paper_id"), 3), "ordinal").select("person_id", "paper_id", "ordinal")


@query("SELECT event_id, coalesce(nullif(CASE WHEN event_type = 'click' THEN '' ELSE event_type END, ''), nullif(props, '')) AS id FROM events")
def d03_first_given(s):
    blank = F.when(F.col("event_type") == "click", "").otherwise(F.col("event_type"))
    return s.raw("events").select("event_id", text.first_given(blank, F.col("props")).alias("id"))


@query("SELECT to_json({'id': c_custkey, 'name': c_name, 'org': n_name}) AS selected FROM customer JOIN nation ON c_nationkey = n_nationkey")
def d04_projection(s):
    return s.scholars().select(F.to_json(F.struct(F.col("person_id").alias("id"), "name", "org")).alias("selected"))


@query("SELECT l_orderkey AS paper_id, l_partkey AS item FROM lineitem")
def d05_flatten(s):
    lists = s.citations().withColumn("ids", F.col("cited.id"))
    return relation.flattened(lists, "paper_id", "ids")


@query("SELECT l_orderkey AS paper_id, count(*) AS total FROM lineitem GROUP BY l_orderkey")
def d06_count(s):
    return s.raw("lineitem").groupBy(F.col("l_orderkey").alias("paper_id")).agg(F.count("*").alias("total"))


@query(
    """SELECT paper_id, CAST(pos AS BIGINT) AS pos, cited_id FROM (
      SELECT l_suppkey AS paper_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS pos,
             CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS cited_id FROM lineitem)
    WHERE pos < 20 AND cited_id IS NOT NULL"""
)
def d07_prefix_filter(s):
    lines = s.raw("lineitem").select(F.col("l_suppkey").alias("paper_id"), "l_orderkey", "l_linenumber", "l_partkey")
    numbered = paging.ranked(lines, ["paper_id"], [F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")], relation.CITED_PREFIX, "n")
    cited = F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey").cast("string"))
    return long(relation.cited_prefix(numbered.select("paper_id", (F.col("n") - 1).alias("pos"), cited.alias("cited_id"))), "pos")


@query("SELECT p_partkey AS patent_id, p_name AS title FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_suppkey = 1)")
def d08_batch_lookup(s):
    keys = s.raw("lineitem").where("l_suppkey = 1").select(F.col("l_partkey").alias("patent_id"))
    return lookup.by_frame(s.patents(), "patent_id", keys).select("patent_id", "title")


@query("SELECT query, patent_id, p_name AS title FROM (SELECT DISTINCT 'red' AS query, p_partkey AS patent_id FROM part WHERE contains(lower(p_name), 'red') ORDER BY 2 LIMIT 3) JOIN part ON p_partkey = patent_id")
def d09_lookup_join(s):
    first = search.patent_search(s.patents(), "red", size=3).select("patent_id")
    return s.patents().join(F.broadcast(first), "patent_id").select(F.lit("red").alias("query"), "patent_id", "title")


@query(
    """WITH keys(k) AS (VALUES (3), (17), (900000001)), a AS (SELECT p_partkey AS k, p_name AS found FROM part WHERE p_partkey IN (SELECT k FROM keys))
    SELECT CAST(k AS BIGINT) AS patent_id, found, 'patent_info' AS route FROM a
    UNION ALL SELECT CAST(k AS BIGINT), 'unknown', 'patent_info -> patent_search' FROM keys WHERE k NOT IN (SELECT k FROM a)"""
)
def d10_fallback(s):
    wanted = s.spark.createDataFrame([(3,), (17,), (900000001,)], "patent_id long")
    first = lookup.by_frame(s.patents(), "patent_id", wanted).select("patent_id", F.col("title").alias("found"))
    second = wanted.withColumn("found", F.lit("unknown"))
    return resolve.with_fallback(first, second, ["patent_id"], ("patent_info", "patent_search"))


_REST = "org_detail > org_person_relation > org_paper_relation > org_patent_relation"


@query(
    f"""WITH q(query, norm) AS (VALUES ('Nation 3', 'nation 3'), ('tion_24', 'tion 24'), ('nowhere', 'nowhere')),
    pro AS (SELECT query FROM q JOIN nation ON lower(replace(n_name, '_', ' ')) = norm),
    hit AS (SELECT DISTINCT query FROM q JOIN nation ON contains(lower(n_name), lower(query)) WHERE query NOT IN (SELECT query FROM pro))
    SELECT query, CASE WHEN query IN (SELECT query FROM pro) OR query IN (SELECT query FROM hit) THEN 'ok' ELSE 'not_found' END AS status,
    CASE WHEN query IN (SELECT query FROM pro) THEN 'org_disambiguate_pro > {_REST}' WHEN query IN (SELECT query FROM hit) THEN 'org_disambiguate_pro > org_search > {_REST}' ELSE 'org_disambiguate_pro > org_search' END AS chain
    FROM q"""
)
def d14_status_and_chain(s):
    """What became of each name, and the operators that were used for it."""
    r = workflows.org_analysis(s.orgs(), s.aliases(), s.scholars(), s.scholar_paper(), s.org_patent(), ["Nation 3", "tion_24", "nowhere"])
    return r.outcomes(s.spark).withColumn("chain", F.array_join("chain", " > "))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def d15_object_or_list(s):
    odd = F.col("event_id") % 2 == 1
    payload = F.when(odd, F.concat(F.lit("["), F.col("props"), F.lit(', {"k": -1}]'))).otherwise(F.col("props"))
    return s.raw("events").select("event_id", text.object_or_list(payload, "struct<k:bigint>")["k"].alias("k"))


@query(
    """SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'a|b' WHEN 1 THEN 'x' WHEN 2 THEN '7' WHEN 3 THEN '""' WHEN 4 THEN 'x y' WHEN 5 THEN '"  "' WHEN 6 THEN '{"a": 1}' WHEN 7 THEN 'a b' END AS ids
    FROM events"""
)
def h3_parse_ids(s):
    given = ['["a", "b"]', '"x"', " 7 ", '""', '" x y\\t"', '"  "', '{"a": 1}', "\ta b\n", " \n "]
    value = F.element_at(F.array(*[F.lit(x) for x in given]), (F.col("event_id") % len(given) + 1).cast("int"))
    return s.raw("events").select("event_id", F.array_join(text.id_list(value), "|").alias("ids"))


@query(
    """SELECT o_orderkey AS paper_id, 'https://example.org/pub/' || o_orderkey AS paper_url, 'https://example.org/profile/' || o_custkey AS scholar_url,
    'https://example.org/patent/' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS patent_url, 'https://venues.test/' || o_orderkey AS venue_url FROM orders"""
)
def l1_links(s):
    even = F.when(F.col("paper_id") % 2 == 0, F.col("paper_id"))
    return s.papers().select("paper_id", text.link("paper", F.col("paper_id")).alias("paper_url"), text.link("scholar", F.col("person_id")).alias("scholar_url"), text.link("patent", even).alias("patent_url"), text.link("venue", F.col("paper_id"), "https://venues.test/").alias("venue_url"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{op}', CAST({p} AS DOUBLE))" for op, p in costs.PRICES.items()) + ") t(op, unit_price)")
def op_cost(s):
    return costs.op_cost(s.spark).withColumn("unit_price", F.col("unit_price").cast("double"))


@query(
    """WITH p AS (SELECT o_orderkey AS paper_id, o_totalprice AS n_citation, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 3)
    SELECT * FROM (SELECT 'most cited' AS list, *, row_number() OVER (ORDER BY n_citation DESC, paper_id) AS ordinal FROM p QUALIFY ordinal <= 5)
    UNION ALL SELECT * FROM (SELECT 'newest', *, row_number() OVER (ORDER BY date DESC, paper_id) AS ordinal FROM p QUALIFY ordinal <= 5)"""
)
def e5_two_rankings(s):
    """Scholars of an institution, their papers, and two lists of five: most cited and newest."""
    people = s.scholars().where("org_id = 3").select("person_id")
    papers = s.papers().join(people, "person_id", "left_semi").select("paper_id", "n_citation", "date")
    lists = [("most cited", "n_citation"), ("newest", "date")]
    parts = [paging.ranked(papers.withColumn("list", F.lit(name)), ["list"], paging.by(column, "paper_id"), 5) for name, column in lists]
    return long(parts[0].unionByName(parts[1]), "ordinal").select("list", "paper_id", "n_citation", "date", "ordinal")
