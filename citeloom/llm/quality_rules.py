"""Quality rules under weak supervision.

Each rule looks at a few counts of a document and votes good, votes bad or
abstains. Expectation-maximisation over the vote patterns estimates, without
labels, how often each rule votes which way on good and on bad documents; the
posterior probability of "good" decides, so no single rule is an all-must-pass
filter. Two base conditions stand in front of it: fewer than `MIN_WORDS` words,
or too many words in repeated five-word windows, always reject.

Words are runs of characters other than ASCII white space. A null text has
none. All counts are native column expressions over the whole text; only the
table of vote patterns, at most 3 ** len(RULES) rows however large the corpus,
comes to the driver. Empty tables give an empty result and the prior model.
Repeated rows each get their own row; null ids and other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, column, cut, let, table, unused, written

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
KEEP_AT = 0.5

#: name: (numerator, denominator, bad above, good at or below); between them the rule abstains.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.10, 0.02),
    "symbol_share": ("n_symbols", "word_chars", 0.05, 0.005),
    "capitals": ("n_upper", "word_chars", 0.40, 0.15),
    "exclaims": ("n_exclaims", "n_words", 0.10, 0.02),
    "repeat_words": ("n_repeat_words", "n_words", 0.18, 0.05),
    "repeat_lines": ("n_dup_lines", "n_lines", 0.40, 0.10),
    "long_words": ("word_chars", "n_words", 16.0, 10.0),
}
NAMES = tuple(RULES)


def _covered(grams: Column) -> Column:
    """Words in windows that occur twice or more: sort windows by (hash, place), mark equal neighbours, then add up the places' cover."""

    def starts(s: Column) -> Column:
        twin = lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | ((j < F.size(s) - 1) & (F.get(s, j + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def total(at: Column) -> Column:
        each = lambda x, k: F.when(k < F.size(at) - 1, F.least(F.get(at, k + 1) - x, F.lit(WINDOW))).otherwise(F.lit(WINDOW))
        return F.aggregate(F.transform(at, each), F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), total)


def features(docs: DataFrame, text_col: str = "text", out: str = "__q") -> DataFrame:
    """`docs` with a struct column `out` of the counts that the rules use.

    Windows are compared by the 64-bit xxhash64 of their words, within one
    document. A document whose window hashes all differ, the usual case, needs
    no more than array_distinct.
    """
    w, l, g = unused(docs, "words", "lines", "windows")  # noqa: E741
    text = F.coalesce(column(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    n = F.size(w) - (WINDOW - 1)
    window = lambda x, i: F.xxhash64(x, *[F.get(F.col(w), i + k) for k in range(1, WINDOW)])
    grams = F.when(n > 0, F.transform(F.slice(w, 1, n), window)).otherwise(F.array().cast("array<bigint>"))
    long = lambda c: c.cast("bigint")
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return (
        docs.withColumns({w: F.array_remove(F.split(text, SPACES, -1), ""), l: lines})
        .withColumn(g, grams)
        .withColumn(
            out,
            F.struct(
                long(F.size(w)).alias("n_words"),
                long(without(SPACES)).alias("word_chars"),
                long(F.length(text) - without(SYMBOLS)).alias("n_symbols"),
                long(F.size(l) - F.size(F.array_distinct(l))).alias("n_dup_lines"),
                long(F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_covered(F.col(g)))).alias("n_repeat_words"),
                long(F.size(l)).alias("n_lines"),
                long(F.length(text) - without(r"\p{Lu}")).alias("n_upper"),
                long(F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).alias("n_exclaims"),
            ),
        )
        .drop(w, l, g)
    )


def base_failed(q: str = "__q") -> Column:
    c = lambda name: F.col(f"{q}.{name}")
    return (c("n_words") < MIN_WORDS) | (c("n_repeat_words") * 100 > c("n_words") * MAX_REPEAT_PERCENT)


def vote(name: str, q: str = "__q") -> Column:
    """1 good, -1 bad, 0 abstains; a zero denominator abstains."""
    top, bottom, bad, good = RULES[name]
    share = F.try_divide(F.col(f"{q}.{top}").cast("double"), F.col(f"{q}.{bottom}").cast("double"))
    return F.when(share > bad, -1).when(share <= good, 1).otherwise(0)


@dataclass(frozen=True)
class LabelModel:
    """prior: share of good documents; rates[rule][vote + 1] = (on bad, on good)."""

    prior: float
    rates: tuple[tuple[tuple[float, float], ...], ...]

    def accuracy(self, rule: int) -> float:
        """Estimated share of right votes among the rule's votes."""
        (b0, g0), _, (b2, g2) = self.rates[rule]
        bad, good = 1 - self.prior, self.prior
        return (bad * b0 + good * g2) / (bad * (b0 + b2) + good * (g0 + g2))

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for v, rates in zip(votes, self.rates, strict=True):
            logs = [math.log(g / b) for b, g in rates]
            odds = odds + F.when(v < 0, logs[0]).when(v > 0, logs[2]).otherwise(logs[1])
        return F.lit(1.0) / (F.exp(-odds) + 1)


#: Expected rates of bad, no and good votes, on bad and on good documents: a rule seldom votes "bad" on a good one.
START = ((0.30, 0.004), (0.10, 0.046), (0.60, 0.95))
#: Expected share of good documents.
START_PRIOR = 0.85
#: Weight of these expectations, as a share of the rows and in rows at most, so that it vanishes as the corpus grows: EM moves off them as far as the votes agree on it.
START_WEIGHT, START_ROWS = 0.25, 1000


def expectation_maximisation(patterns: dict[tuple[int, ...], float], rounds: int = 60) -> LabelModel:
    """Fit by EM on counted vote patterns, with START as a Dirichlet prior."""
    total = sum(patterns.values())
    weight = max(1.0, min(START_ROWS, START_WEIGHT * total))
    model = LabelModel(START_PRIOR, tuple(START for _ in NAMES))
    for _ in range(rounds):
        good_sum, sums = 0.0, [[[weight * (1 - START_PRIOR) * b, weight * START_PRIOR * g] for b, g in START] for _ in NAMES]
        for votes, count in patterns.items():
            odds = math.log(model.prior / (1 - model.prior)) + sum(math.log(model.rates[j][v + 1][1] / model.rates[j][v + 1][0]) for j, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good_sum += p * count
            for j, v in enumerate(votes):
                sums[j][v + 1][0] += (1 - p) * count
                sums[j][v + 1][1] += p * count
        rates = []
        for rule in sums:
            bad, good = sum(x[0] for x in rule), sum(x[1] for x in rule)
            rates.append(tuple((x[0] / bad, x[1] / good) for x in rule))
        prior = (good_sum + START_PRIOR * weight) / (total + weight)
        new = LabelModel(prior, tuple(rates))
        if abs(new.prior - model.prior) < 1e-9:
            return new
        model = new
    return model


def fit(featured: DataFrame, q: str = "__q") -> LabelModel:
    """EM over all rows of a frame with counts, through counts of vote patterns."""
    votes = featured.select(*[vote(n, q).alias(n) for n in NAMES])
    rows = votes.groupBy(*NAMES).count().collect()
    return expectation_maximisation({tuple(int(r[n]) for n in NAMES): float(r["count"]) for r in rows})


def posterior(model: LabelModel, q: str = "__q") -> Column:
    return model.posterior([vote(n, q) for n in NAMES])


def kept(model: LabelModel, q: str = "__q") -> Column:
    return ~base_failed(q) & (posterior(model, q) >= KEEP_AT)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass, with their columns; repeated rows and rows without an id are judged like others.

    The counts take most of the time and both the fit and the filter need them,
    so rows and counts are written once to the shared checkpoint folder; the fit
    reads the counts alone.
    """
    (q,) = unused(docs, "quality_counts")
    counted = written(features(docs, text_col, q))
    return counted.where(kept(fit(counted, q), q)).select(*[column(c) for c in docs.columns])


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _base() -> list[Column]:
    return [F.col("doc_id"), *[F.col(f"__q.{c}").alias(c) for c in BASE], base_failed().alias("base_failed")]


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = cut(features(docs).select("doc_id", "__q"))
    model = fit(counted)
    return counted.select(*_base(), kept(model).alias("kept"), posterior(model).alias("quality"), *[vote(n).alias(f"vote_{n}") for n in NAMES])


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts alone, which SQL can express; the verdicts can't be."""
    return features(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*_base())


BASE_ORACLE = r"""
    WITH w AS (
      SELECT doc_id, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
      FROM documents),
    g AS (
      SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS words
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
    twice AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) GROUP BY doc_id)
    SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len(ws) < 10 OR 100 * coalesce(n, 0) > 20 * len(ws) AS base_failed
    FROM w LEFT JOIN covered USING (doc_id)"""


QUERIES = {"op2_quality_rules": op2_quality_rules, "quality_base_counts": quality_base_counts}
ORACLES = {"quality_base_counts": BASE_ORACLE}
