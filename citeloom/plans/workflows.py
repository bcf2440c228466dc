"""The seven composed workflows.

Each takes canonical frames and a list of name texts and gives its sections as
frames with a `query` column, so one call serves many names in one plan.

Resolution runs at once: its result is at most a few rows a name, so it is
fetched, and what it selects reaches the scans of all sections as pushed `IN`
conditions (up to `INLINE_KEYS` keys; then by a join). Sections are frames that
nobody has computed yet. A section that finds nothing is an empty frame;
`status` tells which names were found, `chain` which operators were used for
each: with a fallback where there was one, without those that had no input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.text import contains
from citeloom.operators import relation, resolve, search
from citeloom.operators.lookup import INLINE_KEYS
from citeloom.operators.paging import by, numbered, page, ranked

LONG = ("query", "section", "ordinal", "entity_id", "label", "metric")
OK, NOT_FOUND, FAILED = "ok", "not_found", "failed"


@dataclass
class Result:
    """Sections by name; status and operators used by query."""

    sections: dict[str, DataFrame] = field(default_factory=dict)
    status: dict[str, str] = field(default_factory=dict)
    chain: dict[str, list[str]] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.sections[name]

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """(query, status, chain) of each query."""
        return spark.createDataFrame([(q, self.status[q], self.chain[q]) for q in self.status], "query string, status string, chain array<string>")

    def long(self, shapes: dict[str, tuple[str | None, str | None, str | None]]) -> DataFrame:
        """All sections as rows (query, section, ordinal, entity_id, label, metric); shapes: the columns of id, label and metric."""
        out = None
        for name, df in self.sections.items():
            key, label, metric = shapes[name]
            pick = lambda c, kind: (F.col(c) if c else F.lit(None)).cast(kind)
            ordinal = F.col("ordinal") if "ordinal" in df.columns else F.lit(1)
            rows = df.select("query", F.lit(name).alias("section"), ordinal.cast("bigint").alias("ordinal"), pick(key, "string").alias("entity_id"), pick(label, "string").alias("label"), pick(metric, "double").alias("metric"))
            out = rows if out is None else out.unionByName(rows)
        return out


def _fetched(found: DataFrame) -> tuple[DataFrame, list]:
    """A resolved frame, at most a few rows a name, as a local one, and its rows."""
    rows = found.collect()
    return found.sparkSession.createDataFrame(rows, found.schema), rows


def _of(df: DataFrame, key: str, one: DataFrame, ids: Sequence) -> DataFrame:
    """Rows of `df` for the selected keys, with their `query`."""
    ids = list(dict.fromkeys(i for i in ids if i is not None))
    near = df.where(F.col(key).isin(ids)) if len(ids) <= INLINE_KEYS else df
    return near.join(F.broadcast(one), key)


def _outcome(names: Sequence[str], first: str, fallback: dict[str, list[str]], found: set[str], rest: Sequence[str]) -> tuple[dict, dict]:
    """(status, chain) by name: the search, its fallback where it was asked, and the rest for what was found."""
    status = {n: OK if n in found else NOT_FOUND for n in names}
    return status, {n: [first, *fallback.get(n, []), *(rest if n in found else [])] for n in names}


def _count(rows: DataFrame) -> DataFrame:
    return rows.groupBy("query").agg(F.count("*").alias("total"))


def scholar_profile(scholars, figures, scholar_paper, scholar_patent, projects, names: Sequence[str]) -> Result:
    """Resolve, then detail, portrait, papers (20), patents (10) and projects (10)."""
    found, rows = _fetched(search.match_names(scholars, "name", names, "person_id", "n_citation", 5))
    one, ids = found.where("ordinal = 1").select("query", "person_id"), [r["person_id"] for r in rows if r["ordinal"] == 1]
    papers = _of(scholar_paper, "person_id", one, ids)
    patents = _of(scholar_patent, "person_id", one, ids).select("query", "patent_id").distinct()
    sections = {
        "search_candidates": found.where("ordinal <= 3"),
        "selected": found.where("ordinal = 1"),
        "detail": _of(scholars, "person_id", one, ids),
        "figure": numbered(_of(figures, "person_id", one, ids), ["query"], [F.asc("interest")]),
        "papers": ranked(papers, ["query"], [F.asc("paper_id")], 20),
        "papers_total": _count(papers),
        "patents": ranked(patents, ["query"], [F.asc("patent_id")], 10),
        "projects": ranked(_of(projects, "person_id", one, ids), ["query"], [F.asc("project_id")], 10),
    }
    rest = ["person_detail", "person_figure", "person_paper_relation", "person_patent_relation", "person_project"]
    return Result(sections, *_outcome(names, "person_search", {}, {r["query"] for r in rows}, rest))


def paper_deep_dive(papers, edges: DataFrame | Callable[[DataFrame], DataFrame], cited_papers, cited_key: str, title: str | None = None, keyword: str | None = None, author: str | None = None, order: str = "n_citation") -> Result:
    """Search (by title with a wider fallback, or under predicates), detail, references, and records of the first twenty.

    `edges` are (paper_id, pos, cited_id), pos from 0, or a function that makes
    them for a frame of papers. A title that no paper has is looked for in
    titles, keywords and abstracts, in the given order.
    """
    if not (title or keyword):
        raise ValueError("give a title or a keyword")
    label = title or keyword
    named = papers.withColumn("query", F.lit(label))
    rank = by(order, "paper_id") if order else [F.asc("paper_id")]
    if keyword or author:
        hits = named.where(search.pro_condition(papers, title=title, keyword=keyword, author=author))
        found, rows = _fetched(ranked(hits, ["query"], rank, 5).withColumn("route", F.lit("paper_search_pro")))
    else:
        hits = named.where(search._either(papers, title, "title", "title_zh"))
        found, rows = _fetched(ranked(hits, ["query"], [F.asc("paper_id")], 5).withColumn("route", F.lit("paper_search")))
        if not rows:
            wider = named.where(search.anywhere(papers, title))
            found, rows = _fetched(ranked(wider, ["query"], rank, 5).withColumn("route", F.lit("paper_search -> paper_search_pro")))
    one, ids = found.where("ordinal = 1").select("query", "paper_id"), [r["paper_id"] for r in rows if r["ordinal"] == 1]
    theirs = _of(edges(one.select("paper_id")) if callable(edges) else edges, "paper_id", one, ids)
    cited, cited_rows = _fetched(relation.cited_prefix(theirs).select("query", F.col("cited_id").alias(cited_key)).distinct())
    info = _of(cited_papers, cited_key, cited, [r[cited_key] for r in cited_rows])
    sections = {
        "search_candidates": found,
        "selected": found.where("ordinal = 1"),
        "detail": _of(papers, "paper_id", one, ids),
        "references_count": _count(theirs),
        "references_preview": theirs.where("pos < 10").withColumn("ordinal", F.col("pos") + 1),
        "cited_papers_info": ranked(info, ["query"], [F.asc(cited_key)], relation.CITED_PREFIX),
    }
    asked = "paper_search_pro" if keyword or author else "paper_search"
    wide = {label: ["paper_search_pro"]} if asked == "paper_search" and (not rows or "->" in rows[0]["route"]) else {}
    rest = ["paper_detail", "paper_relation", *(["paper_info"] if cited_rows else [])]
    return Result(sections, *_outcome([label], asked, wide, {r["query"] for r in rows}, rest))


def org_analysis(orgs, aliases, scholars, scholar_paper, org_patent, names: Sequence[str]) -> Result:
    """Resolve by alias (the primary before the secondary id), else by search; detail, scholars (10), papers (10), patents (100).

    The ids that resolution gives are those of `orgs`.
    """
    pro = resolve.disambiguate_pro(aliases, names)
    first = pro.select("query", F.coalesce("primary_id", "secondary_id").alias("org_id")).where("org_id IS NOT NULL").groupBy("query").agg(F.min("org_id").alias("org_id"))
    second = search.match_names(orgs, "name", names, "org_id", None, 1).select("query", "org_id")
    found, rows = _fetched(resolve.with_fallback(first, second, ["query"], ("org_disambiguate_pro", "org_search")))
    one, ids = found.select("query", "org_id"), [r["org_id"] for r in rows]
    people = _of(scholars, "org_id", one, ids)
    mine = people.select("query", "person_id")
    papers = scholar_paper.join(mine, "person_id").select("query", "paper_id").distinct()
    patents = _of(org_patent, "org_id", one, ids).select("query", "patent_id").distinct()
    sections = {
        "org": found,
        "detail": _of(orgs, "org_id", one, ids),
        "scholars": ranked(people, ["query"], [F.asc("person_id")], 10),
        "scholars_total": _count(people),
        "papers": ranked(papers, ["query"], [F.asc("paper_id")], 10),
        "papers_total": _count(papers),
        "patents": ranked(patents, ["query"], [F.asc("patent_id")], 100),
        "patents_total": _count(patents),
    }
    by_alias = {r["query"] for r in rows if "->" not in r["route"]}
    fallback = {n: ["org_search"] for n in names if n not in by_alias}
    rest = ["org_detail", "org_person_relation", "org_paper_relation", "org_patent_relation"]
    return Result(sections, *_outcome(names, "org_disambiguate_pro", fallback, {r["query"] for r in rows}, rest))


def venue_papers(venues, venue_paper, names: Sequence[str], year: int | None = None, limit: int = 20) -> Result:
    """Resolve, detail, papers of a year or of all."""
    found, got = _fetched(search.match_names(venues, "name", names, "venue_id", None, 3))
    one, ids = found.where("ordinal = 1").select("query", "venue_id"), [r["venue_id"] for r in got if r["ordinal"] == 1]
    rows = venue_paper if year is None else venue_paper.where(F.col("year") == year)
    papers = _of(rows, "venue_id", one, ids).select("query", "paper_id").distinct()
    sections = {
        "search_candidates": found,
        "venue_detail": _of(venues, "venue_id", one, ids),
        "papers": ranked(papers, ["query"], [F.asc("paper_id")], limit),
        "papers_total": _count(papers),
    }
    return Result(sections, *_outcome(names, "venue_search", {}, {r["query"] for r in got}, ["venue_detail", "venue_paper_relation"]))


def paper_qa(papers, query: str | None = None, topic_high=None, topic_middle=None, sci_flag=False, sort_citation=False, sort_year=False, author_id=None, org_id=None, venue_ids=None, size: int = 10) -> DataFrame:
    """Concept search; a query that finds nothing falls back to a plain search by citations, without the filters. Adds `route`."""
    first = search.paper_qa_search(papers, use_topic=topic_high is not None, topic_high=topic_high, topic_middle=topic_middle, sci_flag=sci_flag, force_citation_sort=sort_citation, force_year_sort=sort_year, author_id=author_id, org_id=org_id, venue_ids=venue_ids, query=query, size=size)
    if not query:
        return first.withColumn("route", F.lit("paper_qa_search"))
    text = "keywords" in papers.columns
    hits = papers.where(search.pro_condition(papers, keyword=query)) if text else papers.where(contains(F.col("title"), query))
    second = page(hits, by("n_citation", "paper_id"), 0, size).withColumn("score", F.lit(0.0))
    return resolve.if_empty(first, second.select(*first.columns), ("paper_qa_search", "paper_search_pro"))


def patent_details(patents, query: str, page_no: int = 0, size: int = 10) -> Result:
    """A page of patents, the number of all hits, and the details of the first three."""
    hits = patents.where(search._either(patents, query, "title", "title_zh", "abstract")).withColumn("query", F.lit(query))
    shown, rows = _fetched(ranked(page(hits, [F.asc("patent_id")], page_no, size), ["query"], [F.asc("patent_id")], size))
    first = shown.where("ordinal <= 3").select("query", "patent_id", "ordinal")
    sections = {
        "search_results": shown,
        "total": _count(hits),
        "n_returned": _count(shown),
        "details": _of(patents, "patent_id", first, [r["patent_id"] for r in rows if r["ordinal"] <= 3]),
    }
    return Result(sections, *_outcome([query], "patent_search", {}, {r["query"] for r in rows}, ["patent_detail"]))


def scholar_patents(scholars, scholar_patent, patents, names: Sequence[str]) -> Result:
    """Resolve, list the scholar's patents, details of the first three."""
    found, rows = _fetched(search.match_names(scholars, "name", names, "person_id", "n_citation", 3))
    one, ids = found.where("ordinal = 1").select("query", "person_id"), [r["person_id"] for r in rows if r["ordinal"] == 1]
    held = _of(scholar_patent, "person_id", one, ids).select("query", "patent_id").distinct()
    first, firsts = _fetched(ranked(held, ["query"], [F.asc("patent_id")], 3))
    sections = {
        "scholar": found.where("ordinal = 1"),
        "patents_list": held.withColumn("ordinal", F.lit(0)),
        "patent_details": _of(patents, "patent_id", first, [r["patent_id"] for r in firsts]),
    }
    status, chain = _outcome(names, "person_search", {}, {r["query"] for r in rows}, ["person_patent_relation"])
    for n in {r["query"] for r in firsts}:
        chain[n].append("patent_detail")
    return Result(sections, status, chain)
