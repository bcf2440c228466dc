"""Search operators over the canonical tables (see sources.schemas).

Predicates are built from the arguments that are given, on the driver, so the
optimizer sees plain conditions. What counts as given differs by operator, as
in the services that these stand for: some leave out only None, others
anything falsy, so that an empty id list means no filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import all_of, any_of, contains, groups_of, has_any, token_score, tokens, topic, topic_hits
from citeloom.operators.paging import by, page, ranked, window_of

BRIEF = ("paper_id", "title", "doi")
#: Weights of the middle and low topic groups in the score.
MIDDLE, LOW = 10, 1


def _either(df: DataFrame, text: str, *columns: str) -> Column:
    return any_of(contains(F.col(c), text) for c in columns if c in df.columns)


def anywhere(df: DataFrame, text: str) -> Column:
    """Text in a title, a keyword or an abstract."""
    lists = [F.exists(c, lambda k: contains(k, text)) for c in ("keywords", "keywords_zh") if c in df.columns]
    return any_of([_either(df, text, "title", "title_zh", "abstract", "abstract_zh"), *(F.coalesce(x, F.lit(False)) for x in lists)])


def _author(text: str) -> Column:
    return F.exists("authors", lambda a: contains(a["name"], text))


def _author_org(text: str) -> Column:
    return F.exists("authors", lambda a: contains(a["org"], text))


def _order(order: str | None, score: Column | None = None) -> list[Column]:
    if order not in (None, "", "year", "n_citation"):
        raise ValueError(f"order must be year or n_citation, not {order!r}")
    if order:
        return by(order, "paper_id")
    return [*([score.desc()] if score is not None else []), F.asc("paper_id")]


def paper_search(papers: DataFrame, title: str, page_no: int = 0, size: int = 10) -> DataFrame:
    """Papers whose title contains the text: id, title, doi."""
    hits = papers.where(_either(papers, title, "title", "title_zh"))
    return page(hits, [F.asc("paper_id")], page_no, size).select(*[c for c in BRIEF if c in papers.columns])


def pro_condition(papers: DataFrame, title=None, keyword=None, abstract=None, author=None, org=None, venue=None) -> Column:
    """All of the given predicates; only None is not given."""
    made = {
        "title": lambda x: _either(papers, x, "title", "title_zh"),
        "keyword": lambda x: F.exists("keywords", lambda k: contains(k, x)) if "keywords" in papers.columns else _either(papers, x, "title"),
        "abstract": lambda x: _either(papers, x, "abstract", "abstract_zh"),
        "author": _author,
        "org": _author_org,
        "venue": lambda x: _either(papers, x, "venue_name", "venue_name_zh"),
    }
    given = {"title": title, "keyword": keyword, "abstract": abstract, "author": author, "org": org, "venue": venue}
    return all_of(made[k](v) for k, v in given.items() if v is not None)


def paper_search_pro(papers: DataFrame, title=None, keyword=None, abstract=None, author=None, org=None, venue=None, order: str | None = None, page_no: int = 0, size: int = 10) -> DataFrame:
    """Papers under several predicates; by year or citations, falling, or by id."""
    return page(papers.where(pro_condition(papers, title, keyword, abstract, author, org, venue)), _order(order), page_no, size)


def paper_list_by_search_venue(papers: DataFrame, keyword=None, venue=None, author=None, order: str | None = None, page_no: int = 0, size: int = 10) -> DataFrame:
    """Rich records by exactly one of keyword, venue and author."""
    if sum(x is not None for x in (keyword, venue, author)) != 1:
        raise ValueError("give exactly one of keyword, venue and author")
    return paper_search_pro(papers, keyword=keyword, venue=venue, author=author, order=order, page_no=page_no, size=size)


def paper_list_by_keywords(papers: DataFrame, keywords: Sequence[str], page_no: int = 0, size: int = 10, every: bool = False, column: str | None = None) -> DataFrame:
    """Papers with any (or `every`) of the keywords; in a text `column` where there is no keyword list."""
    has = (lambda k: contains(F.col(column), k)) if column else (lambda k: F.exists("keywords", lambda x: F.lower(x) == k.lower()))
    hits = papers.where((all_of if every else any_of)(has(k) for k in keywords))
    return page(hits, [F.asc("paper_id")], page_no, size)


def paper_qa_search(
    papers: DataFrame,
    use_topic: bool = False,
    topic_high=None,
    topic_middle=None,
    topic_low=None,
    title: Sequence[str] | None = None,
    doi: str | None = None,
    year: Sequence[int] | None = None,
    sci_flag: bool = False,
    n_citation_flag: bool = False,
    size: int = 10,
    offset: int = 0,
    force_citation_sort: bool = False,
    force_year_sort: bool = False,
    author_terms: Sequence[str] | None = None,
    org_terms: Sequence[str] | None = None,
    author_id: Sequence | None = None,
    org_id: Sequence | None = None,
    venue_ids: Sequence | None = None,
    query: str | None = None,
    limited: bool = True,
) -> DataFrame:
    """Scored concept search with filters; adds `score`.

    A query wins over topics. `topic_high` must match (AND of ORs), middle and
    low groups and, with `n_citation_flag`, citations raise the score. Term and
    id filters of the same kind are alternatives. Falsy arguments are not given.
    """
    if force_citation_sort and force_year_sort:
        raise ValueError("the two forced sorts exclude each other")
    text = [F.col(c) for c in ("title", "title_zh", "abstract") if c in papers.columns]
    score, conditions = F.lit(0), []
    if query:
        score = token_score(text, query)
        conditions.append(any_of(contains(c, t) for t in tokens(query) for c in text))
    elif use_topic:
        conditions.append(topic(text, groups_of(topic_high)))
        score = MIDDLE * topic_hits(text, groups_of(topic_middle)) + LOW * topic_hits(text, groups_of(topic_low))
    if title and not use_topic:
        conditions.append(any_of(has_any(F.col(c), title) for c in ("title", "title_zh") if c in papers.columns))
    if doi:
        conditions.append(F.col("doi") == doi)
    if year:
        conditions.append(F.col("year").isin(list(year)))
    if sci_flag:
        conditions.append(F.col("is_sci"))
    people = [*[_author(t) for t in author_terms or []], *([F.exists("authors", lambda a: a["author_id"].isin(list(author_id)))] if author_id else [])]
    places = [*[_author_org(t) for t in org_terms or []], *([F.exists("authors", lambda a: a["org_id"].isin(list(org_id)))] if org_id else [])]
    conditions += [any_of(x) for x in (people, places) if x]
    if venue_ids:
        conditions.append(F.col("venue_id").isin(list(venue_ids)))
    if n_citation_flag:
        score = score + F.log1p(F.greatest(F.coalesce(F.col("n_citation"), F.lit(0)), F.lit(0)))
    hits = papers.where(all_of(conditions)).withColumn("score", score.cast("double"))
    if force_citation_sort:
        order = by("n_citation", "paper_id")
    elif force_year_sort:
        order = by("year", "paper_id")
    else:
        order = [F.desc("score"), *by("n_citation", "paper_id")]
    return window_of(hits, order, offset, size) if limited else hits


def person_search(scholars: DataFrame, name: str | None = None, org: str | None = None, org_id: Sequence | None = None, offset: int = 0, size: int = 5) -> DataFrame:
    """Scholar candidates by a name or place in either language, exact names first; a page of at most ten from an offset on."""
    conditions = [_either(scholars, x, *columns) for columns, x in ((("name", "name_zh"), name), (("org", "org_zh"), org)) if x]
    if org_id:
        conditions.append(F.col("org_id").isin(list(org_id)))
    order = [(F.lower("name") == F.lit((name or "").lower())).desc(), *by("n_citation", "person_id")]
    return window_of(scholars.where(all_of(conditions)), order, offset, min(size, 10))


def org_search(orgs: DataFrame, names: Sequence[str]) -> DataFrame:
    """Institutions that any of the name texts fits, in a name, an alias or an acronym, each once."""
    lists = [c for c in ("aliases", "acronyms") if c in orgs.columns]
    listed = lambda n: any_of(F.coalesce(F.exists(c, lambda x: contains(x, n)), F.lit(False)) for c in lists)
    return orgs.where(any_of(_either(orgs, n, "name", "name_en", "name_zh") | listed(n) for n in names)).dropDuplicates(["org_id"])


def venue_search(venues: DataFrame, name: str, errors: int = 0) -> DataFrame:
    """Venues by name or alias, or with a name at most `errors` letters from the text; `distance` is that of the name."""
    alias = F.coalesce(F.exists("alias", lambda a: contains(a, name)), F.lit(False)) if "alias" in venues.columns else F.lit(False)
    fits = _either(venues, name, "name", "name_en", "name_zh") | alias
    if errors:
        near = lambda c: F.coalesce(F.levenshtein(F.lower(c), F.lit(name.lower()), errors) >= 0, F.lit(False))
        fits = fits | any_of(near(c) for c in ("name", "name_en") if c in venues.columns)
    return venues.where(fits).withColumn("distance", F.levenshtein(F.lower("name"), F.lit(name.lower())))


def patent_search(patents: DataFrame, query: str, page_no: int = 0, size: int = 10) -> DataFrame:
    """Patents by title or abstract."""
    return page(patents.where(_either(patents, query, "title", "title_zh", "abstract")), [F.asc("patent_id")], page_no, size)


def match_names(df: DataFrame, column: str, names: Sequence[str], key: str, cite: str | None, most: int) -> DataFrame:
    """For each of several name texts its first `most` rows: exact names first, then by citations and key.

    The texts are an array literal that each row is held against, so many
    searches are one scan and no join.
    """
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    fits = F.filter(wanted, lambda n: F.contains(F.lower(F.col(column)), F.lower(n)))
    hits = df.withColumn("query", F.explode(fits))
    order = [(F.lower(F.col(column)) == F.lower("query")).desc(), *([F.desc_nulls_last(cite)] if cite else []), F.asc(key)]
    return ranked(hits, ["query"], order, most)
