import io
import json
import urllib.error

import pytest

from citeloom import __main__ as cli
from citeloom.plans import costs
from citeloom.plans.registry import OPERATIONS, Engine
from citeloom.sources import rest
from citeloom.sources.schemas import SCHEMAS
from citeloom.sources.tables import Tables, write_tables
from citeloom.streaming import feeds


def rows(spark, table, *records):
    names = [f.name for f in spark.createDataFrame([], SCHEMAS[table]).schema]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], SCHEMAS[table])


@pytest.fixture(scope="module")
def tables(spark):
    author = {"author_id": "a1", "name": "Ann Lee", "org": "Uni X", "org_id": "o1"}
    full = tuple(author.get(k) for k in ("author_id", "name", "name_zh", "org", "org_zh", "org_id", "email", "homepage", "orc_id"))
    return Tables(
        spark,
        frames={
            "paper": rows(spark, "paper", {"paper_id": "p1", "title": "Deep nets", "year": 2001, "n_citation": 5, "venue_id": "v1", "authors": [full], "keywords": ["nets"]}, {"paper_id": "p2", "title": "Other", "year": 2002, "venue_id": "v1"}),
            "citation": rows(spark, "citation", {"paper_id": "p1", "pos": 0, "cited_id": "p2"}),
            "scholar": rows(spark, "scholar", {"person_id": "a1", "name": "Ann Lee", "org_id": "o1", "n_citation": 3}, {"person_id": "a2", "name": "Ann Leeds", "org_id": "o1", "n_citation": 9}),
            "figure": rows(spark, "figure", {"person_id": "a1", "ai_interests": ["x", "y"]}),
            "scholar_paper": rows(spark, "scholar_paper", {"person_id": "a1", "paper_id": "p1", "title": "Deep nets"}),
            "scholar_patent": rows(spark, "scholar_patent", {"person_id": "a1", "patent_id": "t1"}),
            "project": rows(spark, "project", {"project_id": "j1", "person_id": "a1"}),
            "org": rows(spark, "org", {"org_id": "o1", "name": "Uni X"}),
            "org_alias": rows(spark, "org_alias", {"alias_norm": "uni x", "primary_id": "o1", "primary_name": "Uni X"}),
            "org_patent": rows(spark, "org_patent", {"org_id": "o1", "patent_id": "t1"}),
            "venue": rows(spark, "venue", {"venue_id": "v1", "name": "Journal", "alias": ["J."]}),
            "venue_paper": rows(spark, "venue_paper", {"venue_id": "v1", "paper_id": "p1", "year": 2001}, {"venue_id": "v1", "paper_id": "p2", "year": 2002}),
            "patent": rows(spark, "patent", {"patent_id": "t1", "title": "Red gear"}),
        },
    )


CALLS = {
    "paper_search": ({"title": "deep"}, 1),
    "paper_search_pro": ({"author": "lee"}, 1),
    "paper_qa_search": ({"query": "deep other"}, 2),
    "paper_info": ({"ids": ["p1", "p2"]}, 2),
    "paper_detail": ({"paper_id": "p1"}, 1),
    "paper_relation": ({"paper_id": "p1"}, 1),
    "paper_list_by_search_venue": ({"keyword": "net"}, 1),
    "paper_list_by_keywords": ({"keywords": ["nets"]}, 1),
    "paper_detail_by_condition": ({"year": 2001, "venue_id": "v1"}, 1),
    "person_search": ({"name": "ann"}, 2),
    "person_detail": ({"person_id": "a1"}, 1),
    "person_figure": ({"person_id": "a1"}, 1),
    "person_paper_relation": ({"person_id": "a1"}, 1),
    "person_patent_relation": ({"person_id": "a1"}, 1),
    "person_project": ({"person_id": "a1"}, 1),
    "org_search": ({"orgs": ["uni", "x"]}, 1),
    "org_detail": ({"ids": ["o1"]}, 1),
    "org_person_relation": ({"org_id": "o1"}, 2),
    "org_paper_relation": ({"org_id": "o1"}, 1),
    "org_patent_relation": ({"org_id": "o1"}, 1),
    "org_disambiguate": ({"org": "Uni-X"}, 1),
    "org_disambiguate_pro": ({"org": "uni  x"}, 1),
    "venue_search": ({"name": "j."}, 1),
    "venue_detail": ({"venue_id": "v1"}, 1),
    "venue_paper_relation": ({"venue_id": "v1", "year": 2002}, 1),
    "patent_search": ({"query": "GEAR"}, 1),
    "patent_info": ({"patent_id": "t1"}, 1),
    "patent_detail": ({"patent_id": "t1"}, 1),
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_operation(name, tables):
    params, n = CALLS[name]
    assert Engine(tables).run(name, **params).count() == n


def test_every_operation_is_priced_and_tested():
    assert set(CALLS) == set(costs.PRICES) and set(CALLS) < OPERATIONS and len(OPERATIONS) == 35
    assert str(costs.cost_of(["person_search", "person_detail", "person_figure", "person_paper_relation", "person_patent_relation", "person_project"])) == "7.50"
    assert costs.cheapest(["paper_detail", "paper_info"]) == "paper_info"


def test_workflows(tables):
    e = Engine(tables)
    profile = e.run("scholar_profile", name="Ann Lee")
    assert profile["selected"].first().person_id == "a1"  # the exact name before the more cited one
    assert profile["papers_total"].first().total == 1 and profile["figure"].count() == 2
    assert e.run("scholar_profile", name="nobody")["detail"].count() == 0
    assert e.run("paper_deep_dive", title="deep")["cited_papers_info"].count() == 1
    org = e.run("org_analysis", org=["UNI X", "uni"])
    assert {(r.query, r.route) for r in org["org"].collect()} == {("UNI X", "org_disambiguate_pro"), ("uni", "org_disambiguate_pro -> org_search")}
    assert e.run("venue_papers", venue="journal", year=2001)["papers_total"].first().total == 1
    qa = e.run("paper_qa", query="deep", venue_ids='["zzz"]')
    assert qa.count() == 0  # the fallback looks in keywords
    assert e.run("patent_details", query="gear")["details"].count() == 1
    assert e.run("scholar_patents", name="ann lee")["patent_details"].count() == 1


def test_dispatch_refuses_what_is_not_listed(tables):
    e = Engine(tables)
    for name in ("run", "__init__", "t", "os"):
        with pytest.raises(KeyError):
            e.run(name)
    with pytest.raises(TypeError):
        e.run("paper_detail", wrong=1)


def test_status_tells_not_found_from_failed(tables, spark, tmp_path):
    e = Engine(tables)
    assert e.attempt("scholar_profile", name="Ann Lee").status == "ok"
    nobody = e.attempt("scholar_profile", name=["nobody", "Ann Lee"])
    assert nobody.status == "ok" and nobody.result.status == {"nobody": "not_found", "Ann Lee": "ok"}
    assert nobody.result.chain["nobody"] == ["person_search"] and len(nobody.result.chain["Ann Lee"]) == 6
    assert e.attempt("scholar_profile", name="nobody").status == e.attempt("paper_detail", paper_id="p9").status == "not_found"
    assert e.attempt("org_analysis", org="nowhere").result.chain == {"nowhere": ["org_disambiguate_pro", "org_search"]}
    got = Engine(Tables(spark, str(tmp_path / "absent"))).attempt("paper_detail", paper_id="p1")
    assert got.status == "failed" and got.result is None and "absent" in got.error
    with pytest.raises(KeyError):
        e.attempt("attempt")
    rows = {r.query: (r.status, r.chain) for r in nobody.result.outcomes(spark).collect()}
    assert rows["nobody"] == ("not_found", ["person_search"])


def test_command_line(tables, tmp_path, capsys, spark):
    write_tables(tables, str(tmp_path))
    assert cli.main(["--root", str(tmp_path), "--action", "raw", "--api", "paper_info", "--params", '{"ids": ["p1"]}']) == 0
    assert json.loads(capsys.readouterr().out)["row"]["paper_id"] == "p1"
    assert cli.call(cli.parser().parse_args(["--root", "x", "--action", "venue_papers", "--venue", "v"]))[1] == {"venue": "v", "limit": 10}
    assert cli.main(["--root", str(tmp_path / "absent"), "--action", "org_analysis", "--org", "x"]) == 1
    assert '"failed"' in capsys.readouterr().err
    assert cli.main(["--root", str(tmp_path), "--action", "org_analysis", "--org", "nowhere"]) == 0
    assert '"not_found"' in capsys.readouterr().err
    assert cli.main(["--root", str(tmp_path), "--action", "venue_papers", "--venue", "journal", "--size", "1"]) == 0
    assert sum('"papers"' in x for x in capsys.readouterr().out.splitlines()) == 1
    for bad in (["--action", "paper_deep_dive"], ["--action", "scholar_profile"], ["--action", "paper_qa", "--query", "x", "--sort_year", "--sort_citation"], ["--action", "raw"]):
        with pytest.raises(SystemExit):
            cli.main(["--root", str(tmp_path), *bad])


class Answer(io.BytesIO):
    pass


def test_rest_fetch_tries_again():
    waits, calls = [], []

    def opener(request, timeout):
        calls.append((request.full_url, timeout))
        if len(calls) == 1:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {}, None)
        if len(calls) == 2:
            raise urllib.error.URLError("down")
        return Answer('{"data": {"id": "é"}}'.encode())

    got = rest.fetch("http://x/y", opener=opener, wait=waits.append)
    assert rest.records(got) == [{"id": "é"}] and len(calls) == 3 and calls[0][1] == 30
    assert 1 <= waits[0] <= 1.3 and 2 <= waits[1] <= 2.3

    def refuse(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 401, "no", {}, None)

    with pytest.raises(rest.RestError) as e:
        rest.fetch("http://x", opener=refuse, wait=waits.append)
    assert e.value.status == 401 and not e.value.again and len(waits) == 2
    with pytest.raises(rest.RestError):
        rest.fetch("http://x", opener=lambda *a, **k: Answer(b"not json"), wait=waits.append)


def test_rest_answers_that_break_off():
    import http.client

    class Broken(io.BytesIO):
        def __init__(self, error):
            super().__init__()
            self.error = error

        def read(self, *args):
            raise self.error

    for error in (ConnectionResetError("gone"), http.client.IncompleteRead(b"{")):
        with pytest.raises(rest.RestError) as e:
            rest.fetch("http://x", opener=lambda *a, error=error, **k: Broken(error), wait=lambda s: None)
        assert not e.value.again and "broke off" in str(e.value)


def test_rest_values_follow_the_schema(spark):
    import datetime
    import decimal

    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string("a string, b string, c bigint, d bigint, e double, f boolean, g date, h decimal(9,2), i array<string>, j int")
    value = {"a": 7, "b": {"x": "é"}, "c": "12", "d": 1.5, "e": 3, "f": "True", "g": "2020-01-02", "h": 1.25, "i": "one", "j": "no"}
    assert rest.shaped(value, kind) == ("7", '{"x": "é"}', 12, None, 3.0, True, datetime.date(2020, 1, 2), decimal.Decimal("1.25"), ["one"], None)


def test_rest_parts():
    assert rest.address("u", {"a": None, "b": ["x"], "c": 1}) == "u?b=%5B%22x%22%5D&c=1"
    assert rest.records([{"a": 1}, 3]) == [{"a": 1}] and rest.records({"data": None}) == []


def test_rest_source(spark):
    import threading
    import urllib.parse
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Pages(BaseHTTPRequestHandler):
        def answer(self, params):
            seen.append((self.command, self.headers.get("x-key"), params["q"]))
            n = int(params["page"])
            rows = [{"id": f"{n}-{i}", "names": ["é", None], "venue": {"id": i}, "more": 1} for i in range(int(params["size"]))]
            body = json.dumps({"data": rows if n < 2 else None}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.answer(dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query)))

        def do_POST(self):
            self.answer(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(rest.RestSource)
        for method in ("get", "post"):
            reader = spark.read.format("rest").schema("id string, names array<string>, venue struct<id:int>, absent string")
            options = {"url": f"http://127.0.0.1:{server.server_port}/x", "method": method, "pages": 3, "size": 2, "params": '{"q": "ü"}', "header.X-Key": "k"}
            got = sorted(reader.options(**options).load().collect())
            assert [r.id for r in got] == ["0-0", "0-1", "1-0", "1-1"]
            assert got[1].names == ["é", None] and got[1].venue.id == 1 and got[1].absent is None
        assert set(seen) == {("GET", "k", "ü"), ("POST", "k", "ü")}
    finally:
        server.shutdown()


def test_feed_keeps_each_key_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from citeloom.functions.text import contains

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"paper_id": "p1", "title": "Deep"}\n{"paper_id": "p1", "title": "Deep"}\n{"paper_id": "p2", "title": "Flat"}\n')
    rows = feeds.matching(feeds.feed(spark, str(folder), "paper"), contains(F.col("title"), "deep"), "paper_id")
    feeds.store(rows, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(60)
    assert [r.paper_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["p1"]
