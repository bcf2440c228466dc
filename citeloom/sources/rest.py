"""A REST source: records of a JSON service as a Spark data source.

    spark.dataSource.register(RestSource)
    spark.read.format("rest").option("url", ...).option("pages", 10).schema(...).load()

One partition a page; each fetches its page with a time limit, repeated tries
on failures that may pass, and growing waits. A page is a JSON object whose
`data` is a record or a list of records, or such a list itself; fields are
taken by the schema's names and other fields are left.
"""

from __future__ import annotations

import datetime
import decimal
import http.client
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, DecimalType, FractionalType, IntegralType, StringType, StructType, TimestampNTZType, TimestampType

# fixed values: time limit and tries of a request, and statuses that may pass
TIMEOUT_SECONDS, TRIES = 30, 3
PASSING = frozenset((408, 429, 500, 502, 503, 504))


class RestError(Exception):
    """A request that failed for good; `again` tells whether trying later may help."""

    def __init__(self, message: str, status: int | None = None, again: bool = False):
        super().__init__(message)
        self.status, self.again = status, again


def address(url: str, params: dict) -> str:
    """A GET address; None is left out, lists and objects go as JSON."""
    given = {k: json.dumps(v, ensure_ascii=False) if isinstance(v, list | dict) else v for k, v in params.items() if v is not None}
    return f"{url}?{urllib.parse.urlencode(given)}" if given else url


def fetch(url: str, headers: dict[str, str] | None = None, body: bytes | None = None, tries: int = TRIES, opener: Callable = urllib.request.urlopen, wait: Callable = time.sleep):
    """Parsed JSON of one request. Waits 1, 2, ... seconds and a little more between tries."""
    for n in range(tries):
        last = n == tries - 1
        try:
            with opener(urllib.request.Request(url, data=body, headers=headers or {}), timeout=TIMEOUT_SECONDS) as answer:
                return json.loads(answer.read().decode("utf-8"))
        except urllib.error.HTTPError as e:
            if e.code not in PASSING or last:
                raise RestError(f"status {e.code}", e.code, e.code in PASSING) from e
        except (urllib.error.URLError, TimeoutError) as e:
            if last:
                raise RestError(f"no answer: {e}", again=True) from e
        except ValueError as e:
            raise RestError(f"no JSON: {e}") from e
        except (OSError, http.client.HTTPException) as e:
            raise RestError(f"answer broke off: {e}") from e
        wait(2**n + random.uniform(0, 0.3))
    raise RestError("no tries")


def records(answer) -> list[dict]:
    """Records of an answer: `data` of an object, or the answer itself; one object is a list of one."""
    data = answer.get("data") if isinstance(answer, dict) and "data" in answer else answer
    if isinstance(data, dict):
        return [data]
    return [x for x in data or [] if isinstance(x, dict)]


def shaped(value, kind: DataType):
    """A JSON value under a Spark type; structs become tuples, what does not fit the type is None."""
    if value is None:
        return None
    if isinstance(kind, StructType):
        return tuple(shaped(value.get(f.name), f.dataType) for f in kind.fields) if isinstance(value, dict) else None
    if isinstance(kind, ArrayType):
        return [shaped(x, kind.elementType) for x in (value if isinstance(value, list) else [value])]
    try:
        return _plain(value, kind)
    except (ValueError, TypeError, ArithmeticError):
        return None


def _plain(value, kind: DataType):
    """A JSON value as one of a plain type; what does not fit is an error."""
    if isinstance(kind, StringType):
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if isinstance(kind, BooleanType):
        return value if isinstance(value, bool) else {"true": True, "false": False}.get(str(value).lower())
    if isinstance(kind, IntegralType):
        number = decimal.Decimal(str(value))
        return int(number) if number == int(number) else None
    if isinstance(kind, FractionalType):
        return decimal.Decimal(str(value)) if isinstance(kind, DecimalType) else float(value)
    if isinstance(kind, DateType):
        return datetime.date.fromisoformat(value)
    if isinstance(kind, TimestampType | TimestampNTZType):
        return datetime.datetime.fromisoformat(value)
    return value


class RestSource(DataSource):
    """Options: url, method (get or post), pages, first (number of the first page), page_param, size_param, size, params (JSON), header.NAME.

    By get the parameters are in the address, by post they are a JSON body.
    """

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> str:
        return "id string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return RestReader(schema, dict(self.options))


class RestReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.options = schema, options

    def partitions(self) -> list[InputPartition]:
        first = int(self.options.get("first", 0))
        return [InputPartition(first + i) for i in range(int(self.options.get("pages", 1)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        params = {**json.loads(o.get("params", "{}")), o.get("page_param", "page"): partition.value, o.get("size_param", "size"): int(o.get("size", 10))}
        headers = {k[len("header.") :]: v for k, v in o.items() if k.startswith("header.")}
        if o.get("method", "get").lower() == "post":
            answer = fetch(o["url"], {"Content-Type": "application/json", **headers}, json.dumps(params, ensure_ascii=False).encode())
        else:
            answer = fetch(address(o["url"], params), headers)
        for row in records(answer):
            yield shaped(row, self.schema)
