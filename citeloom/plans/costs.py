"""Prices of the operators and of chains of them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# fixed values: price of one call, in CNY
PRICES = {
    "paper_search": "0.00",
    "paper_search_pro": "0.01",
    "paper_qa_search": "0.05",
    "paper_info": "0.00",
    "paper_detail": "0.01",
    "paper_relation": "0.10",
    "paper_list_by_search_venue": "0.30",
    "paper_list_by_keywords": "0.10",
    "paper_detail_by_condition": "0.20",
    "person_search": "0.00",
    "person_detail": "1.00",
    "person_figure": "0.50",
    "person_paper_relation": "1.50",
    "person_patent_relation": "1.50",
    "person_project": "3.00",
    "org_search": "0.00",
    "org_detail": "0.01",
    "org_person_relation": "0.50",
    "org_paper_relation": "0.10",
    "org_patent_relation": "0.10",
    "org_disambiguate": "0.01",
    "org_disambiguate_pro": "0.05",
    "venue_search": "0.00",
    "venue_detail": "0.20",
    "venue_paper_relation": "0.10",
    "patent_search": "0.00",
    "patent_info": "0.00",
    "patent_detail": "0.01",
}


def price(op: str) -> Decimal:
    return Decimal(PRICES[op])


def cost_of(chain: list[str]) -> Decimal:
    """Price of a chain of calls."""
    return sum((price(op) for op in chain), Decimal("0.00"))


def cheapest(ops: list[str]) -> str:
    """The cheapest of several operators that would do; the first of equals."""
    return min(ops, key=lambda op: (price(op), ops.index(op)))


def op_cost(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(op, Decimal(p)) for op, p in PRICES.items()], "op string, unit_price decimal(6,2)")
