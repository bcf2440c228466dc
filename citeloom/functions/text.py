"""Text and value functions shared by the operators: all of them are column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Link prefixes by entity; callers may pass their own.
LINK_BASES = {"paper": "https://example.org/pub/", "scholar": "https://example.org/profile/", "patent": "https://example.org/patent/", "venue": "https://example.org/journal/"}


def contains(column: Column, text: str) -> Column:
    """Case-insensitive literal containment; `%` and `_` have no meaning, NULL contains nothing."""
    return F.coalesce(F.contains(F.lower(column), F.lit(text.lower())), F.lit(False))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def has_any(column: Column, terms: Sequence[str]) -> Column:
    return any_of(contains(column, t) for t in terms)


def topic(columns: Sequence[Column], groups: Sequence[Sequence[str]]) -> Column:
    """AND over groups of the OR over a group's terms, each looked for in any of the columns. An empty group asks for nothing."""
    return all_of(any_of(contains(c, t) for t in group for c in columns) for group in groups if group)


def topic_hits(columns: Sequence[Column], groups: Sequence[Sequence[str]]) -> Column:
    """Number of groups of which a term is found."""
    return reduce(lambda a, b: a + b, (any_of(contains(c, t) for t in g for c in columns).cast("int") for g in groups if g), F.lit(0))


def tokens(query: str) -> list[str]:
    """Distinct lower-cased words of a query, in order."""
    return list(dict.fromkeys(query.lower().split()))


def token_score(columns: Sequence[Column], query: str) -> Column:
    """Number of the query's words that are found."""
    return reduce(lambda a, b: a + b, (any_of(contains(c, t) for c in columns).cast("int") for t in tokens(query)), F.lit(0))


def first_given(*columns: Column) -> Column:
    """The first that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def normalised_name(column: Column) -> Column:
    """Lower case, white space and punctuation as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(column), r"[\s\p{Punct}]+", " "))


def link(entity: str, key: Column, base: str | None = None) -> Column:
    """The entity's address; NULL without a key."""
    return F.concat(F.lit(base or LINK_BASES[entity]), key.cast("string"))


def object_or_list(payload: Column, element: str) -> Column:
    """First object of a JSON payload that is an object or a list of them; NULL for anything else."""
    return F.try_element_at(F.from_json(payload, f"array<{element}>"), F.lit(1))


def stripped(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def id_list(value: Column) -> Column:
    """Ids of an argument's text: a JSON list as it is, a JSON string, stripped, as one id, other text as one id, blank as NULL. A blank JSON string is other text."""
    text = stripped(value)
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    inner = stripped(F.try_variant_get(parsed, "$", "string"))
    single = F.when((kind == "STRING") & (inner != ""), F.array(inner))
    several = F.when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get(parsed, "$", "array<string>"))
    return F.when(text != "", F.coalesce(single, several, F.array(text)))


def parse_ids(value: Any) -> list[str] | None:
    """The same for a Python argument: lists pass, blank is None."""
    import json

    if not value or isinstance(value, list):
        return value or None
    text = str(value).strip()
    if not text:
        return None
    try:
        parsed = json.loads(text)
    except ValueError:
        return [text]
    if isinstance(parsed, list):
        return parsed
    return [parsed.strip()] if isinstance(parsed, str) and parsed.strip() else [text]


def groups_of(value: str | Sequence[Sequence[str]] | None) -> list[list[str]]:
    """Topic groups from nested lists or their JSON text."""
    import json

    if not value:
        return []
    return [list(g) for g in (json.loads(value) if isinstance(value, str) else value)]
