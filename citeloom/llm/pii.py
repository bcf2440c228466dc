"""Personal data: regular expressions propose spans, checksums confirm them, nearby words move the score.

Kinds, in order: email, ip, card, phone (the base kinds), iban, ssn.

- email, ip (parts at most 255), card (14 to 19 digits, Luhn) and phone (10 to
  15 digits) follow fixed patterns, leftmost and without overlap within a kind;
  what fails its check is dropped. They are always reported.
- iban needs the mod-97 check; in groups of four it ends where its country's
  ones do, whatever word follows (other countries': with the last group); ssn has no checksum and needs a context word.
- Each span has a score: the kind's own, raised by a context word in the 40
  characters before it or the 20 after it (as far as the next hit of the kind).
  iban and ssn are reported from `REPORT_AT` on.

Everything is native column expressions over the whole text. `split` gives the
gaps between a pattern's matches and `regexp_extract_all` the matches, so the
offsets (code points, end exclusive) are running sums of their lengths, taken
in blocks so that a text with tens of thousands of matches stays cheap. The
patterns are possessive and anchored at the first character of a run, so no
text makes them backtrack far. A null text counts as empty and has no spans;
empty tables give empty results; repeated rows and null ids are reported row by
row, and other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, let, table, unused

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
REPORT_AT = 0.7

#: Countries by the length of their IBAN.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ DO ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _grouped() -> str:
    """IBANs in groups of four, each as long as its country's."""
    body = lambda n: rf"(?:\x20[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    return "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}{body(n)}" for n, c in IBAN_LENGTHS.items())


#: The base patterns, with possessive runs. A run of local-part characters or digits is entered at its start or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_grouped()}|[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?:\x20[A-Z0-9]{{4}}){{2,7}}(?:\x20[A-Z0-9]{{1,3}})?))(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without this cannot hold the kind.
HINTS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": r"mail|contact|write|reach",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|visa|master|amex|credit|debit|pay",
    "phone": r"phone|call|tel|fax|mobile|whatsapp",
    "iban": r"iban|bank|account|transfer|konto",
    "ssn": r"ssn|social|security|tax",
}
CONTEXT_GAIN = 0.3
BLOCK = 64


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = lambda c, i: let((F.ascii(c) - 48) * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v))
    return F.aggregate(F.transform(F.split(digits, "", -1), lambda c, i: F.when(c == "", 0).otherwise(value(c, i))), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN, without spaces, leaves 1 on division by 97."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))
    step = lambda r, c: F.when(c == "", r).when(c <= "9", (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, "", -1), F.lit(0), step) == 1


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        small = lambda p: let(F.ltrim(p, F.lit("0")), lambda x: (F.length(x) <= 2) | ((F.length(x) == 3) & (x <= "255")))
        return F.forall(F.split(hit, r"\.", -1), small)
    if kind == "card":
        return F.length(hit).between(14, 37) & let(_digits(hit), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(hit, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~F.rlike(hit, F.lit(r"^(000|666|9)|-00-|-0000$"))
    return F.lit(True)


NO_SPANS = "array<struct<start:int,kind:int,stop:int,score:double>>"


def _kind_spans(kind: str, text: Column) -> Column:
    pattern = PATTERNS[kind]

    def located(gaps: Column, hits: Column) -> Column:
        widths = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))

        def with_sums(w: Column) -> Column:
            add = lambda a, x: a + x
            total = lambda xs: F.aggregate(xs, F.lit(0), add)
            blocks = F.transform(F.sequence(F.lit(0), (F.size(w) - 1).cast("bigint").__truediv__(BLOCK).cast("int")), lambda b: total(F.slice(w, b * BLOCK + 1, F.lit(BLOCK))))

            def with_blocks(sums: Column) -> Column:
                block = lambda i: F.floor(i / BLOCK).cast("int")
                before = F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))

                def with_before(at: Column) -> Column:
                    start = lambda i: F.get(at, block(i)) + total(F.slice(w, block(i) * BLOCK + 1, i % BLOCK)) + F.length(F.get(gaps, i))
                    near = lambda i: F.lower(F.concat_ws(" ", F.right(F.get(gaps, i), F.lit(40)), F.left(F.get(gaps, i + 1), F.lit(20))))
                    score = lambda i: F.lit(SCORES[kind]) + F.when(F.rlike(near(i), F.lit(CONTEXT[kind])), CONTEXT_GAIN).otherwise(0.0)
                    good = F.filter(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: _valid(kind, F.get(hits, i)))
                    span = lambda i: let(start(i), lambda s: F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s + F.length(F.get(hits, i))).alias("stop"), F.least(score(i), F.lit(1.0)).alias("score")))
                    return F.transform(good, span)

                return let(before, with_before)

            return let(blocks, with_blocks)

        return let(widths, with_sums)

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = let(hits, lambda h: F.when(F.size(h) > 0, let(F.split(text, pattern, -1), lambda g: located(g, h))))
    if kind in HINTS:
        spans = F.when(F.contains(text, F.lit(HINTS[kind])), spans)
    spans = F.coalesce(spans, F.array().cast(NO_SPANS))
    return spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= REPORT_AT)


def spans(text: Column) -> Column:
    """All spans of a text, by start and then kind: array of (start, kind, stop, score)."""
    text = F.coalesce(text, F.lit(""))
    return F.sort_array(F.concat(*[_kind_spans(k, text) for k in KINDS]))


def _names() -> Column:
    return F.array(*[F.lit(k) for k in KINDS])


def render(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(_names(), s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(F.get(_names(), s["kind"])), F.lit("]"))
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(piece))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = let(F.aggregate(found, start, step), lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1)))
    return F.when(F.size(found) > 0, done).otherwise(text)


def find_pii(docs: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """`docs` with an array column of spans; a column of that name is replaced."""
    return docs.withColumn(out, spans(column(text_col)))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with the spans of the text replaced; the length column, if there, follows the text. Nulls, other columns and their names stay as they are."""
    (found,) = unused(docs, "pii_found")
    out = find_pii(docs, text_col, found).withColumn(text_col, redacted(column(text_col), F.col(found)))
    if length_col in docs.columns:
        kind = dict(docs.dtypes)[length_col]
        out = out.withColumn(length_col, F.when(F.size(found) > 0, F.length(column(text_col)).cast(kind)).otherwise(column(length_col)))
    return out.select(*[column(c) for c in docs.columns])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["kind"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter("pii_spans", lambda s: s["kind"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    score = F.array_max(F.transform("pii_spans", lambda s: s["score"]))
    return docs.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(render(base), 256).alias("base_sha256"), render(F.col("pii_spans")).alias("spans"), score.alias("top_score"))


def _oracle() -> str:
    """The same in SQL. Its patterns have no look-around, so the neighbours of iban and ssn are looked at afterwards."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+){3}",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    digits = "regexp_replace(h, '[^0-9]', '', 'g')"
    chars = f"string_split(reverse({digits}), '')"
    doubled = f"list_transform({chars}, lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN CAST(c AS INT) * 2 - 9 ELSE CAST(c AS INT) * 2 END)"
    code = "CASE WHEN c <= '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END"
    body = "replace(h, ' ', '')"
    turned = f"string_split(substr({body}, 5) || left({body}, 4), '')"
    alone = lambda c: f"NOT regexp_matches(before, '{c}$') AND NOT regexp_matches(after, '^{c}')"
    small = "list_aggregate(list_transform(string_split(h, '.'), lambda p: length(ltrim(p, '0')) <= 2 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') <= '255')), 'bool_and')"
    valid = {
        "email": "true",
        "ip": small,
        "card": f"length({digits}) BETWEEN 14 AND 19 AND list_sum({doubled}) % 10 = 0",
        "phone": f"length({digits}) BETWEEN 10 AND 15",
        "iban": f"{alone('[A-Za-z0-9]')} AND list_reduce(list_prepend(0, list_transform({turned}, lambda c: {code})), lambda r, v: CASE WHEN v < 10 THEN r * 10 + v ELSE r * 100 + v END % 97) = 1",
        "ssn": f"{alone('[0-9-]')} AND NOT regexp_matches(h, '^(000|666|9)|-00-|-0000$')",
    }
    parts = []
    for k, kind in enumerate(KINDS):
        near = f"regexp_matches(lower(concat_ws(' ', right(before, 40), left(after, 20))), '{CONTEXT[kind]}')"
        parts.append(f"""
      SELECT doc_id, {k} AS k, '{kind}' AS kind, start, start + length(h) AS stop,
             least(CAST({SCORES[kind]} AS DOUBLE) + CASE WHEN {near} THEN CAST({CONTEXT_GAIN} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END, CAST(1 AS DOUBLE)) AS score
      FROM (
        SELECT doc_id, hits[i] AS h, gaps[i] AS before, gaps[i + 1] AS after,
               list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: length(x))), 0) AS start
        FROM (
          SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '{plain[kind]}') AS hits, string_split_regex(t, '{plain[kind]}') AS gaps FROM d)))
      WHERE {valid[kind]}""")
    every = " UNION ALL ".join(parts)
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k, stop)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    spans AS (SELECT * FROM ({every}) WHERE k < {len(BASE_KINDS)} OR score >= {REPORT_AT}),
    found AS (
      SELECT doc_id, {counts}, {joined} FILTER (k < {len(BASE_KINDS)}) AS base, {joined} AS spans, max(score) AS top_score
      FROM spans GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, top_score
    FROM d LEFT JOIN found ON found.doc_id = d.doc_id"""


QUERIES = {"op10_pii": op10_pii}
ORACLES = {"op10_pii": _oracle()}
