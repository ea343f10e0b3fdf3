"""Quality by weak supervision: rules vote or abstain, and are believed as far as they deserve.

Each rule looks at one statistic of a text and votes good, votes bad or abstains.  Texts
with the same votes are counted together, so what expectation-maximisation sees is a table
of vote patterns, whose size depends on the number of rules only.  It estimates how often
each rule is right and how many texts are good; a text's posterior probability of being good
then follows from its votes.  Everything that touches texts is a Spark expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import BLANKS, WORD, fenced

SYMBOLS = r"[#*$%&|<>]"
#: A word without letter or digit, between blanks.
BARE_MARKS = rf"[{BLANKS}][^\p{{L}}\p{{N}}{BLANKS}]+[{BLANKS}]"


@dataclass(frozen=True)
class Rule:
    """Good at or below ``good``, bad above ``bad``, else no vote; of a ratio of two counts.

    With ``rising`` it is good at or above ``good`` and bad below ``bad``.  Nothing to
    divide by means no vote.
    """

    name: str
    count: str
    of: str
    good: float
    bad: float
    rising: bool = False


RULES = (
    Rule("enough_words", "n_words", "one", 80, 50, rising=True),
    Rule("word_length", "word_chars", "n_words", 9.0, 14.0),
    Rule("no_stubs", "word_chars", "n_words", 3.0, 2.0, rising=True),
    Rule("few_symbols", "n_symbols", "n_words", 0.05, 0.2),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", 0.2, 0.5),
    Rule("few_repeated_words", "n_repeat_words", "n_words", 0.25, 0.5),
    Rule("few_capitals", "n_capitals", "n_letters", 0.2, 0.5),
    Rule("mostly_letters", "n_letters", "word_chars", 0.85, 0.7, rising=True),
    Rule("few_shouts", "n_shouts", "n_words", 0.05, 0.2),
    Rule("few_bare_marks", "n_bare_marks", "n_words", 0.03, 0.1),
)


def text_statistics(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts over every whole text, in the columns that the rules name.

    A null text counts as empty: all counts are 0.  A word counts as repeated if it lies in a
    window of three words that is found twice or more in the text, at whichever place.
    Windows are compared by 64-bit hashes; sorting them, not joining, finds the equal ones.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        *[F.col(c).alias(f"__{i}") for i, c in enumerate(carry)],
        fenced(F.regexp_extract_all(own, F.lit(WORD), F.lit(0))).alias("words"),
        F.filter(F.split(own, "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_replace(own, rf"[{BLANKS}]+", "").alias("solid"),
        F.regexp_count(own, F.lit(BARE_MARKS)).alias("bare_marks"),
    )
    last = F.size("words") - 3
    hashes = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("at")
        ),
    )
    base = base.withColumn("windows", fenced(F.sort_array(hashes)))
    again = F.filter(
        "windows",
        lambda x, i: F.coalesce(x["h"] == F.get("windows", i - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("windows", i + 1)["h"], F.lit(False)),
    )
    base = base.withColumn("again", fenced(F.sort_array(F.transform(again, lambda x: x["at"]))))
    # a repeated window adds the words up to the next one's begin, three at most
    steps = F.transform(
        "again", lambda at, i: F.least(F.lit(3), F.coalesce(F.get("again", i + 1) - at, F.lit(3)))
    )
    return base.select(
        *[F.col(f"__{i}").alias(c) for i, c in enumerate(carry)],
        fenced(F.size("words").cast("long")).alias("n_words"),
        F.length("solid").cast("long").alias("word_chars"),
        F.regexp_count("solid", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("solid", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("solid", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.regexp_count("solid", F.lit(r"[!?]{2,}")).cast("long").alias("n_shouts"),
        F.col("bare_marks").cast("long").alias("n_bare_marks"),
    )


def vote(rule: Rule) -> Column:
    """1 good, -1 bad, 0 no vote."""
    of = F.lit(1) if rule.of == "one" else F.col(rule.of)
    ratio = F.col(rule.count) / F.when(of > 0, of)
    good, bad = (ratio >= rule.good, ratio < rule.bad) if rule.rising else (ratio <= rule.good, ratio > rule.bad)
    return F.coalesce(F.when(good, 1).when(bad, -1), F.lit(0))


#: First guess of a rule's accuracy on good and on bad texts, and of the share of good texts.
START = (0.99, 0.15, 0.7)
#: Rules are written so that they seldom speak against a good text: bounds of that accuracy.
ON_GOOD = (0.98, 0.999)
#: Bounds of the accuracy on bad texts and of the share of good texts.
ON_BAD, SHARE = (0.03, 0.98), (0.05, 0.95)


def estimate(
    patterns: list[tuple[tuple[int, ...], int]],
    rounds: int = 12,
    start: tuple[float, float, float] = START,
) -> tuple[list[tuple[float, float]], float]:
    """How often each rule's votes are right, and the share of good texts, from vote patterns.

    A rule has two accuracies: how often it votes good where the text is good, and how often
    it votes bad where the text is bad; of texts on which it abstains it says nothing, and rules
    err independently of each other.  ``start`` has the first guess of both and of the share.
    Estimates stay within bounds at which a vote never speaks for its opposite, so good and
    bad cannot change places.  Without any pattern the starting values come back.
    """
    rules = range(len(patterns[0][0])) if patterns else range(0)
    right = [start[:2] for _ in rules]
    share = start[2]
    for _ in range(rounds if patterns else 0):
        weights = _weights(right)
        sums = [[0.0, 0.0, 0.0, 0.0] for _ in rules]  # good and voted good, good; bad and voted bad, bad
        good, total = 0.0, 0
        for votes, n in patterns:
            p = 1 / (1 + math.exp(-_logit(share, weights, votes)))
            good, total = good + n * p, total + n
            for j in rules:
                if votes[j]:
                    sums[j][0] += n * p * (votes[j] > 0)
                    sums[j][1] += n * p
                    sums[j][2] += n * (1 - p) * (votes[j] < 0)
                    sums[j][3] += n * (1 - p)
        right = [_bounded(s, r) for s, r in zip(sums, right, strict=True)]
        share = min(max(good / total, SHARE[0]), SHARE[1])
    return right, share


def _bounded(sums: list[float], old: tuple[float, float]) -> tuple[float, float]:
    """The new accuracies; those of a class without votes stay."""
    on_good = min(max(sums[0] / sums[1], ON_GOOD[0]), ON_GOOD[1]) if sums[1] > 0 else old[0]
    on_bad = min(max(sums[2] / sums[3], ON_BAD[0]), ON_BAD[1]) if sums[3] > 0 else old[1]
    return on_good, on_bad


def _weights(right: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """What a good and what a bad vote add to the logit."""
    return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in right]


def _logit(share: float, weights: list[tuple[float, float]], votes: tuple[int, ...]) -> float:
    said = (w[v < 0] for w, v in zip(weights, votes, strict=True) if v)
    return math.log(share / (1 - share)) + sum(said)


def judge(stats: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``posterior`` (six decimals) to a table of statistics.

    The estimates come from the votes of all rows of ``stats``.  The counted patterns, at
    most 3 to the power of the number of rules, are the only thing that reaches the driver.
    """
    names = [f"__v{i}" for i in range(len(rules))]
    counted = (
        stats.select(*[vote(r).alias(n) for r, n in zip(rules, names, strict=True)])
        .groupBy(*names)
        .agg(F.count("*").alias("n"))
        .orderBy(*names)
        .collect()
    )
    right, share = estimate([(tuple(row[:-1]), row[-1]) for row in counted])
    logit = F.lit(math.log(share / (1 - share)))
    for rule, (good, bad) in zip(rules, _weights(right), strict=False):
        said = vote(rule)
        logit = logit + F.when(said > 0, good).when(said < 0, bad).otherwise(0.0)
    return stats.withColumn("posterior", fenced(F.round(1 / (1 + F.exp(-logit)), 6)))
