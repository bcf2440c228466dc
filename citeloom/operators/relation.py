"""Relations: citations, and what scholars, institutions and venues hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import first_given
from citeloom.operators.paging import page, window_of

ORG_PAGE, PATENT_CAP, CITED_PREFIX = 10, 10_000, 20


def cited(nested: DataFrame) -> DataFrame:
    """(paper_id, pos, cited_id, cited_title) from a list of cited papers in each row; an empty or missing list gives no row."""
    rows = nested.select("paper_id", F.posexplode("cited").alias("pos", "c"))
    fields = nested.schema["cited"].dataType.elementType.fieldNames()
    key = first_given(*[F.col(f"c.{f}").cast("string") for f in ("_id", "id") if f in fields])
    return rows.select("paper_id", "pos", key.alias("cited_id"), F.col("c.title").alias("cited_title") if "title" in fields else F.lit(None).cast("string").alias("cited_title"))


def cited_prefix(edges: DataFrame, most: int = CITED_PREFIX) -> DataFrame:
    """The first `most` edges of each paper by position, of those the ones with an id: prefix first, then the filter."""
    return edges.where((F.col("pos") < most) & F.col("cited_id").isNotNull())


def flattened(df: DataFrame, key: str, lists: str) -> DataFrame:
    """All items of a key's lists, one row each; a missing list is empty."""
    return df.select(key, F.explode(F.coalesce(lists, F.array())).alias("item"))


def held_by(bridge: DataFrame, owner: str, value) -> DataFrame:
    """Rows of a bridge table for one owner."""
    return bridge.where(F.col(owner) == F.lit(value))


def org_page(rows: DataFrame, key: str, offset: int = 0) -> DataFrame:
    """Ten rows of an institution from an offset on."""
    return window_of(rows, [F.asc(key)], offset, ORG_PAGE)


def org_papers(papers: DataFrame, scholar_paper: DataFrame, scholars: DataFrame, org_id) -> DataFrame:
    """Papers by an institution's scholars, each once."""
    people = scholars.where(F.col("org_id") == F.lit(org_id)).select("person_id")
    theirs = scholar_paper.join(people, "person_id", "left_semi").select("paper_id")
    return papers.join(theirs, "paper_id", "left_semi")


def org_patents(org_patent: DataFrame, org_id, page_no: int = 1, page_size: int = 100) -> DataFrame:
    """Patent ids of an institution; pages count from 1 and hold 10 000 at most."""
    ids = org_patent.where(F.col("org_id") == F.lit(org_id)).select("patent_id").distinct()
    return page(ids, [F.asc("patent_id")], page_no, page_size, base=1, cap=PATENT_CAP)


def venue_papers(venue_paper: DataFrame, venue_id, year: int | None = None, offset: int = 0, limit: int = 20) -> DataFrame:
    """A venue's papers, of one year if given (0 is a year too)."""
    return window_of(venue_papers_all(venue_paper, venue_id, year), [F.asc("paper_id")], offset, limit)


def venue_papers_all(venue_paper: DataFrame, venue_id, year: int | None = None) -> DataFrame:
    rows = venue_paper.where(F.col("venue_id") == F.lit(venue_id))
    if year is not None:
        rows = rows.where(F.col("year") == year)
    return rows.select("paper_id").distinct()


def papers_of_year(venue_paper: DataFrame, year: int, venue_id=None) -> DataFrame:
    """All papers of a venue in a year; without a venue there are none."""
    if not venue_id:
        return venue_paper.select("paper_id").limit(0)
    return venue_papers_all(venue_paper, venue_id, year)
