import random

import pytest

from citeloom.llm import url_filter as u


def brute_glob(symbols, text):
    """Backtracking match of parsed symbols."""

    def at(i, j):
        if i == len(symbols):
            return j == len(text)
        s = symbols[i]
        if s in (u.RUN, u.DEEP):
            return at(i + 1, j) or (j < len(text) and (s == u.DEEP or text[j] != "/") and at(i, j + 1))
        return j < len(text) and (text[j] != "/" if s == u.ANY else ord(text[j]) == s) and at(i + 1, j + 1)

    return at(0, 0)


def test_automaton_equals_backtracking():
    rnd = random.Random(1)
    globs = ["".join(rnd.choice(["a", "b", "/", "*", "**", "?", "é", "ab"]) for _ in range(rnd.randint(0, 7))) for _ in range(90)]
    rules = [[u.parse_glob(g)] for g in globs]
    machine = u.Automaton.compile(rules)
    assert machine.start.shape[0] > 2  # several words
    texts = ["".join(rnd.choice("ab/é日") for _ in range(rnd.randint(0, 9))) for _ in range(300)] + ["", "a" * 70]
    hit = machine.match(texts, budget=40)
    for i, t in enumerate(texts):
        for j, r in enumerate(rules):
            assert hit[i, j] == brute_glob(r[0], t), (t, globs[j])


def test_canonical():
    assert u.canonical("HTTP://A.Com/En/X?y#z") == ("a.com", "/En/X")
    assert u.canonical("x://É.COM#a/b") == ("É.com", "")
    assert u.canonical("http://h?x://y") == ("h", "")
    assert u.canonical(None) == u.canonical("no scheme") == ("", "")
    assert u.canonical("a://b://c/d") == ("b:", "//c/d")


def test_longest_rule_wins():
    run = u.judge(u.HOST_RULES, u.BLOCK_GLOBS)
    urls = ["http://com/en/", "http://x.example.com/en/7a", "http://badexample.com/en/7", "http://example.com/EN/", "https://example.net/de/8", "http://a.org/es", "http://casino.org/x", None, "http://org.com/es/"]
    hosts, paths, rules, verdicts, globs = run(urls)
    assert rules == ["com/en/", "example.com/en/7", "com/en/", None, "example.net/de/8", None, None, None, None]
    assert verdicts == ["block", "allow", "block", "allow", "block", "allow", "block", "allow", "allow"]
    assert globs[6] == "*casino*"


@pytest.mark.parametrize(
    ("url", "rule", "verdict"),
    [
        ("http://com/en/", "com/en/", "block"),
        ("http://a.com/en/x", "com/en/", "block"),
        ("http://example.com/en/6", "com/en/", "block"),
        ("http://example.com/en/7", "example.com/en/7", "allow"),
        ("http://w.example.com/en/71?q", "example.com/en/7", "allow"),
        ("http://net/de/", "net/de/", "allow"),
        ("http://a.net/de/casino.exe", "net/de/", "allow"),
        ("http://example.net/de/7", "net/de/", "allow"),
        ("http://example.net/de/8", "example.net/de/8", "block"),
        ("http://W.Example.NET/de/89#x", "example.net/de/8", "block"),
        ("http://org/es/", "org/es/", "block"),
        ("http://example.org/es/8", "org/es/", "block"),
        ("http://a.org/de/8", None, "allow"),
        ("http://notcom/en/", None, "allow"),
    ],
)
def test_the_five_rules(url, rule, verdict):
    """By host, subdomain and longer rule, as the contract words them."""
    _, _, rules, verdicts, _ = u.judge(u.HOST_RULES, u.BLOCK_GLOBS)([url])
    assert (rules, verdicts) == ([rule], [verdict])


def test_frames(spark, middle, same):
    assert same(u.op1_url_filter, u.ORACLES["op1_url_filter"], middle) == 250
    odd = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "http://a.com/en/" + "z" * 300_000, "y"), (2, "", None)], "page_id long, url string, verdict string")
    got = sorted((r.page_id or 0, r.verdict, len(r.path)) for r in u.url_verdicts(odd).collect())
    assert got == [(0, "block", 300_004), (1, "allow", 0), (1, "allow", 0), (2, "allow", 0)]
    assert u.url_verdicts(odd.where("false")).count() == 0


@pytest.mark.parametrize("block", [(), ("**",)])
def test_rule_sets(block):
    run = u.judge((), block)
    assert run(["http://x/"])[3] == ["block" if block else "allow"]
