"""URL filters by a bit-parallel wildcard automaton.

Glob rules are packed side by side into the bits of one multiword Shift-And
register; every character of a URL moves all rules at once. A rule's bits are
a start bit followed by one bit for each symbol. `*` is any run of characters
other than `/`, `**` any run at all, `?` one character other than `/`. Both
runs are self-loops on the bit in front of them.

URLs are judged in canonical form, host + path: the host (lower-cased A-Z) is
what stands after the first `://` up to `/`, `?`, `#` or the end, the path
what follows up to `?`, `#` or the end. A null url, or one without `://`, has
an empty host and path and is allowed unless a glob fits the empty string.
Repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import LOWER, UPPER, map_arrow, table

ANY, RUN, DEEP = -1, -2, -3
LOWERED = str.maketrans(UPPER, LOWER)

#: (action, host, path): fits the host and its subdomains where the path starts so.
HOST_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)

#: Globs that block where no host rule fits. One without `/` is about the host.
BLOCK_GLOBS = (
    "*spam-farm*",
    "*cheap-pills*",
    "*casino*",
    "*viagra*",
    "**/wp-login.php",
    "**/cgi-bin/**",
    "**.exe",
    "**.zip",
)


def canonical(url: str | None) -> tuple[str, str]:
    """Host and path of a url, both empty where it has no `://`."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(LOWERED), path


def parse_glob(glob: str) -> list[int]:
    """Symbols of a glob: code points, ANY, RUN or DEEP."""
    out: list[int] = []
    i = 0
    while i < len(glob):
        if glob.startswith("**", i):
            out.append(DEEP)
            i += 2
            continue
        out.append({"*": RUN, "?": ANY}.get(glob[i], ord(glob[i])))
        i += 1
    return out


def expand_glob(glob: str) -> list[list[int]]:
    symbols = parse_glob(glob)
    if "/" in glob or DEEP in symbols:
        return [symbols]
    return [symbols, [*symbols, ord("/"), DEEP]]


def expand_host_rule(host: str, path: str) -> list[list[int]]:
    tail = [*map(ord, host + path), DEEP]
    return [tail, [RUN, ord("."), *tail]]


@dataclass
class Automaton:
    """Masks of the packed rules; `owner[i]` is the rule of final bit i."""

    codes: np.ndarray
    step: np.ndarray
    loop: np.ndarray
    start: np.ndarray
    finals: list[tuple[int, int]]
    owner: np.ndarray
    rules: int

    @classmethod
    def compile(cls, rules: list[list[list[int]]]) -> Automaton:
        """rules: for each rule its alternative symbol lists."""
        codes = np.array(sorted({s for rule in rules for alt in rule for s in alt if s >= 0} | {ord("/")}), dtype=np.uint32)
        place = {int(c): i + 1 for i, c in enumerate(codes)}
        slash = place[ord("/")]
        bits = sum(1 + sum(s > RUN for s in alt) for rule in rules for alt in rule)
        words = max(1, -(-bits // 64))
        step, loop, start = [0] * (len(codes) + 1), [0] * (len(codes) + 1), 0
        finals, owner, at = [], [], 0
        for number, rule in enumerate(rules):
            for alt in rule:
                start |= 1 << at
                for s in alt:
                    if s in (RUN, DEEP):
                        for c in range(len(loop)):
                            if s == DEEP or c != slash:
                                loop[c] |= 1 << at
                        continue
                    at += 1
                    for c in [place[s]] if s >= 0 else [c for c in range(len(step)) if c != slash]:
                        step[c] |= 1 << at
                finals.append(divmod(at, 64))
                owner.append(number)
                at += 1
        pack = lambda x: [(x >> (64 * w)) & (2**64 - 1) for w in range(words)]
        make = lambda xs: np.array([pack(x) for x in xs], dtype=np.uint64)
        return cls(codes, make(step), make(loop), make([start])[0], finals, np.array(owner), len(rules))

    def _classes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.codes, points), len(self.codes) - 1)
        return np.where(self.codes[at] == points, at + 1, 0)

    def match(self, texts: list[str], budget: int = 4_000_000) -> np.ndarray:
        """Boolean matrix: text x rule. Texts go in blocks of at most `budget` padded characters."""
        hit = np.zeros((len(texts), self.rules), dtype=bool)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        at = 0
        while at < len(order):
            longest = max(1, len(texts[order[at]]))
            block = order[at : at + max(1, budget // longest)]
            at += len(block)
            state = self._run([texts[i] for i in block])
            for (word, bit), rule in zip(self.finals, self.owner, strict=True):
                hit[block, rule] |= (state[:, word] >> np.uint64(bit)) & np.uint64(1) > 0
        return hit

    def _run(self, texts: list[str]) -> np.ndarray:
        """Final registers of texts in order of falling length."""
        n, one, top = len(texts), np.uint64(1), np.uint64(63)
        lengths = np.array([len(t) for t in texts])
        codes = np.zeros((n, max(1, int(lengths[0]))), dtype=np.int64)
        for i, t in enumerate(texts):
            codes[i, : len(t)] = self._classes(t)
        state = np.tile(self.start, (n, 1))
        for i in range(int(lengths[0])):
            live = int(np.searchsorted(-lengths, -i, side="left"))
            d, c = state[:live], codes[:live, i]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            moved &= self.step[c]
            moved |= d & self.loop[c]
            state[:live] = moved
            if not moved.any():
                break
        return state


def judge(host_rules, block_globs):
    """A function from urls to (hosts, paths, rules, verdicts, globs)."""
    rules = [expand_host_rule(h, p) for _, h, p in host_rules] + [expand_glob(g) for g in block_globs]
    automaton = Automaton.compile(rules)
    names = [h + p for _, h, p in host_rules]
    # the longest rule wins; of equally long ones that with the longer host, then a block
    rank = sorted(range(len(names)), key=lambda r: (-len(names[r]), -len(host_rules[r][1]), host_rules[r][0] != "block", r))

    def run(urls: list[str | None]):
        parts = [canonical(u) for u in urls]
        hit = automaton.match([h + p for h, p in parts])
        rule, verdict, globs = [], [], []
        for row in hit:
            best = next((r for r in rank if row[r]), None)
            fits = [block_globs[g] for g in range(len(block_globs)) if row[len(names) + g]]
            rule.append(None if best is None else names[best])
            globs.append(",".join(fits) or None)
            verdict.append(host_rules[best][0] if best is not None else "block" if fits else "allow")
        return [h for h, _ in parts], [p for _, p in parts], rule, verdict, globs

    return run


def url_verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", host_rules=HOST_RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """One row for each row of `pages`: id, host, path, rule, verdict and the globs that fit.

    A null url counts as one without `://`; an empty table gives an empty result.
    """
    run = judge(host_rules, block_globs)
    kind = dict(pages.dtypes)[id_col]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        host, path, rule, verdict, globs = run(b.column(1).to_pylist())
        text = [pa.array(x, pa.string()) for x in (host, path, rule, verdict, globs)]
        return pa.RecordBatch.from_arrays([b.column(0), *text], ["page_id", "host", "path", "rule", "verdict", "globs"])

    return map_arrow(pages.select(id_col, url_col), batch, f"page_id {kind}, host string, path string, rule string, verdict string, globs string", rows=10_000)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


# Written out by hand, so that it does not follow the rules above: the longest rule that fits wins, and the globs decide for the rest.
ORACLE = r"""
    WITH parts AS (
      SELECT page_id,
             translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    rules(rule, action, rule_host, rule_path) AS (VALUES
      ('com/en/', 'block', 'com', '/en/'),
      ('example.com/en/7', 'allow', 'example.com', '/en/7'),
      ('net/de/', 'allow', 'net', '/de/'),
      ('example.net/de/8', 'block', 'example.net', '/de/8'),
      ('org/es/', 'block', 'org', '/es/')),
    best AS (
      SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
      FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY page_id),
    globbed AS (
      SELECT page_id, nullif(concat_ws(',',
        CASE WHEN regexp_matches(host || path, '^[^/]*spam-farm[^/]*(/(?s:.*))?$') THEN '*spam-farm*' END,
        CASE WHEN regexp_matches(host || path, '^[^/]*cheap-pills[^/]*(/(?s:.*))?$') THEN '*cheap-pills*' END,
        CASE WHEN regexp_matches(host || path, '^[^/]*casino[^/]*(/(?s:.*))?$') THEN '*casino*' END,
        CASE WHEN regexp_matches(host || path, '^[^/]*viagra[^/]*(/(?s:.*))?$') THEN '*viagra*' END,
        CASE WHEN ends_with(host || path, '/wp-login.php') THEN '**/wp-login.php' END,
        CASE WHEN contains(host || path, '/cgi-bin/') THEN '**/cgi-bin/**' END,
        CASE WHEN ends_with(host || path, '.exe') THEN '**.exe' END,
        CASE WHEN ends_with(host || path, '.zip') THEN '**.zip' END), '') AS globs
      FROM parts)
    SELECT p.page_id, host, path, rule, coalesce(action, CASE WHEN globs IS NULL THEN 'allow' ELSE 'block' END) AS verdict, globs
    FROM parts p LEFT JOIN best USING (page_id) JOIN globbed USING (page_id)"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": ORACLE}
