"""Operators and workflows by name, over canonical tables.

`Engine.run(name, **params)` dispatches over an allow-list; unknown names and
unknown parameters are errors, raised before anything is planned.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import parse_ids
from citeloom.operators import lookup, relation, resolve, search
from citeloom.plans import workflows
from citeloom.sources.rest import RestError
from citeloom.sources.tables import Tables

PAPER_BASIC = ("paper_id", "title", "title_zh", "authors", "year", "venue_id", "venue_name", "issue", "volume")
PATENT_BASIC = ("patent_id", "title", "title_zh", "app_num", "pub_num", "pub_kind", "inventor", "country", "sequence")


class Engine:
    """All operators on one set of tables."""

    def __init__(self, tables: Tables):
        self.t = tables

    # papers
    def paper_search(self, title: str, page: int = 0, size: int = 10) -> DataFrame:
        return search.paper_search(self.t["paper"], title, page, size)

    def paper_search_pro(self, title=None, keyword=None, abstract=None, author=None, org=None, venue=None, order=None, page: int = 0, size: int = 10) -> DataFrame:
        return search.paper_search_pro(self.t["paper"], title, keyword, abstract, author, org, venue, order, page, size)

    def paper_qa_search(self, **params) -> DataFrame:
        return search.paper_qa_search(self.t["paper"], **params)

    def paper_info(self, ids: list) -> DataFrame:
        return lookup.by_keys(self.t["paper"], "paper_id", parse_ids(ids) or [], PAPER_BASIC)

    def paper_detail(self, paper_id) -> DataFrame:
        return lookup.by_key(self.t["paper"], "paper_id", paper_id)

    def paper_relation(self, paper_id) -> DataFrame:
        return relation.held_by(self.t["citation"], "paper_id", paper_id).orderBy("pos")

    def paper_list_by_search_venue(self, keyword=None, venue=None, author=None, order=None, page: int = 0, size: int = 10) -> DataFrame:
        return search.paper_list_by_search_venue(self.t["paper"], keyword, venue, author, order, page, size)

    def paper_list_by_keywords(self, keywords: list, page: int = 0, size: int = 10, every: bool = False) -> DataFrame:
        return search.paper_list_by_keywords(self.t["paper"], keywords, page, size, every)

    def paper_detail_by_condition(self, year: int, venue_id=None) -> DataFrame:
        papers = self.t["paper"]
        return papers.where((F.col("venue_id") == F.lit(venue_id)) & (F.col("year") == year)) if venue_id else papers.limit(0)

    # scholars
    def person_search(self, name=None, org=None, org_id: list | None = None, offset: int = 0, size: int = 5) -> DataFrame:
        return search.person_search(self.t["scholar"], name, org, org_id, offset, size)

    def person_detail(self, person_id) -> DataFrame:
        return lookup.by_key(self.t["scholar"], "person_id", person_id)

    def person_figure(self, person_id) -> DataFrame:
        return lookup.by_key(self.t["figure"], "person_id", person_id)

    def person_paper_relation(self, person_id) -> DataFrame:
        return relation.held_by(self.t["scholar_paper"], "person_id", person_id)

    def person_patent_relation(self, person_id) -> DataFrame:
        return relation.held_by(self.t["scholar_patent"], "person_id", person_id)

    def person_project(self, person_id) -> DataFrame:
        return relation.held_by(self.t["project"], "person_id", person_id)

    # institutions
    def org_search(self, orgs: list) -> DataFrame:
        return search.org_search(self.t["org"], orgs)

    def org_detail(self, ids: list) -> DataFrame:
        return lookup.by_keys(self.t["org"], "org_id", parse_ids(ids) or [])

    def org_person_relation(self, org_id, offset: int = 0) -> DataFrame:
        return relation.org_page(relation.held_by(self.t["scholar"], "org_id", org_id), "person_id", offset)

    def org_paper_relation(self, org_id, offset: int = 0) -> DataFrame:
        papers = relation.org_papers(self.t["paper"], self.t["scholar_paper"], self.t["scholar"], org_id)
        return relation.org_page(papers, "paper_id", offset)

    def org_patent_relation(self, org_id, page: int = 1, page_size: int = 100) -> DataFrame:
        return relation.org_patents(self.t["org_patent"], org_id, page, page_size)

    def org_disambiguate(self, org: str) -> DataFrame:
        return resolve.disambiguate(self.t["org_alias"], [org])

    def org_disambiguate_pro(self, org: str) -> DataFrame:
        return resolve.disambiguate_pro(self.t["org_alias"], [org])

    # venues and patents
    def venue_search(self, name: str) -> DataFrame:
        return search.venue_search(self.t["venue"], name, errors=len(name) // 5).orderBy("distance", "venue_id")

    def venue_detail(self, venue_id) -> DataFrame:
        return lookup.by_key(self.t["venue"], "venue_id", venue_id)

    def venue_paper_relation(self, venue_id, offset: int = 0, limit: int = 20, year: int | None = None) -> DataFrame:
        return relation.venue_papers(self.t["venue_paper"], venue_id, year, offset, limit)

    def patent_search(self, query: str, page: int = 0, size: int = 10) -> DataFrame:
        return search.patent_search(self.t["patent"], query, page, size)

    def patent_info(self, patent_id) -> DataFrame:
        return lookup.by_key(self.t["patent"], "patent_id", patent_id, PATENT_BASIC)

    def patent_detail(self, patent_id) -> DataFrame:
        return lookup.by_key(self.t["patent"], "patent_id", patent_id)

    # workflows
    def scholar_profile(self, name: str | list[str]) -> workflows.Result:
        figures = self.t["figure"].select("person_id", F.explode_outer("ai_interests").alias("interest"))
        return workflows.scholar_profile(self.t["scholar"], figures, self.t["scholar_paper"], self.t["scholar_patent"], self.t["project"], _list(name))

    def paper_deep_dive(self, title=None, keyword=None, author=None, order: str = "n_citation") -> workflows.Result:
        cited = self.t["paper"].select(F.col("paper_id").alias("cited_paper_id"), "title", "year")
        return workflows.paper_deep_dive(self.t["paper"], self.t["citation"].select("paper_id", "pos", "cited_id"), cited, "cited_paper_id", title, keyword, author, order)

    def org_analysis(self, org: str | list[str]) -> workflows.Result:
        return workflows.org_analysis(self.t["org"], self.t["org_alias"], self.t["scholar"], self.t["scholar_paper"], self.t["org_patent"], _list(org))

    def venue_papers(self, venue: str | list[str], year: int | None = None, limit: int = 20) -> workflows.Result:
        return workflows.venue_papers(self.t["venue"], self.t["venue_paper"], _list(venue), year, limit)

    def paper_qa(self, **params) -> DataFrame:
        for name in ("author_id", "org_id", "venue_ids"):
            params[name] = parse_ids(params.get(name))
        return workflows.paper_qa(self.t["paper"], **params)

    def patent_details(self, query: str, page: int = 0, size: int = 10) -> workflows.Result:
        return workflows.patent_details(self.t["patent"], query, page, size)

    def scholar_patents(self, name: str | list[str]) -> workflows.Result:
        return workflows.scholar_patents(self.t["scholar"], self.t["scholar_patent"], self.t["patent"], _list(name))

    def run(self, name: str, /, **params) -> Any:
        """The operator or workflow of that name; parameters that are None are left out."""
        if name not in OPERATIONS:
            raise KeyError(f"no operation {name!r}; there are {', '.join(sorted(OPERATIONS))}")
        fn: Callable = getattr(self, name)
        given = {k: v for k, v in params.items() if v is not None}
        inspect.signature(fn).bind(**given)
        return fn(**given)

    def attempt(self, name: str, /, **params) -> Outcome:
        """`run` with a status: `ok`, `not_found` for a result without rows, `failed` where tables or services can't be read.

        Wrong names and parameters are errors of the caller and are raised.
        """
        try:
            result = self.run(name, **params)
            found = workflows.OK in result.status.values() if isinstance(result, workflows.Result) else not result.isEmpty()
        except (PySparkException, RestError) as e:
            return Outcome(workflows.FAILED, error=str(e))
        return Outcome(workflows.OK if found else workflows.NOT_FOUND, result)


@dataclass
class Outcome:
    """What `Engine.attempt` came to: status, the result unless it failed, and the reason if it did."""

    status: str
    result: Any = None
    error: str | None = None


def _list(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


#: What `run` may call.
OPERATIONS = frozenset(k for k, v in vars(Engine).items() if callable(v) and not k.startswith("_") and k not in ("run", "attempt"))
