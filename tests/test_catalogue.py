import re

import pytest

import __spark_entry__ as entry
from citeloom.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(name, same, middle):
    assert same(catalogue.QUERIES[name], catalogue.ORACLES[name], middle) > 0


def test_inventory_is_covered():
    names = set(catalogue.QUERIES)
    for n in range(1, 29):
        assert any(re.match(rf"f{n:02}_", x) for x in names), n
    for n in range(1, 8):
        assert any(x.startswith(f"w{n}_") for x in names), n


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 10
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_push_filters_and_prune_columns(spark, middle):
    plan = catalogue.QUERIES["f15_person_project"](spark, middle)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(user_id,5)" in plan and "props" not in plan.split("ReadSchema")[1]
    top = catalogue.QUERIES["f01_paper_search"](spark, middle)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top
    limited = catalogue.QUERIES["d02_top_n"](spark, middle)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in limited


def test_citations_of_all_papers_are_given(spark, middle):
    edges = catalogue.QUERIES["f06_paper_relation"](spark, middle)
    assert edges.count() == spark.read.parquet(f"{middle}/lineitem.parquet").count()
    assert edges.where("paper_id NOT BETWEEN 10 AND 400").count() > 0


@pytest.mark.parametrize(("name", "source"), [("l1_links", "orders"), ("d04_projection", "customer"), ("d03_first_given", "events"), ("d15_object_or_list", "events"), ("h3_parse_ids", "events")])
def test_whole_tables_are_projected(spark, middle, name, source):
    assert catalogue.QUERIES[name](spark, middle).count() == spark.read.parquet(f"{middle}/{source}.parquet").count()


def test_what_resolution_selects_reaches_the_scans(spark, middle):
    """Each scan of a section has the selected keys as a pushed condition."""
    plan = catalogue.QUERIES["w2_paper_deep_dive"](spark, middle)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "FileScan" in x and "lineitem" in x]
    assert lines and all("l_orderkey" in x.split("PushedFilters")[1] for x in lines)
