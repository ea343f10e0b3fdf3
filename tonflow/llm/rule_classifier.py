"""A quality classifier of few, readable rules.

Small boosted trees are grown on statistics of labelled texts; each path in a tree is a rule,
a conjunction of thresholds.  A lasso logistic regression over all rules keeps the few that
matter.  Those are compiled into one Spark expression over the statistics, which are Spark
expressions over the text themselves: no text leaves the JVM to be scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import BLANKS, fenced

#: name -> pattern whose matches are counted in the text
COUNTED = {
    "symbols": r"[#*$%&|<>{}\[\]\\^~=_+@]",
    "stops": r"[.,;:]",
    "shouts": r"[!?]{2,}",
    "decorated": r"\p{L}[#*$%&]{2,}",
    "capital_words": r"\b\p{Lu}{2,}\b",
    "digits": r"\p{Nd}",
    "letters": r"\p{L}+",
    "twice": r"\b(\p{L}++) \1\b",  # only the whole run of letters can be followed by a blank
}
PIPE = " | "


def statistics(docs: DataFrame, text: str, kept: Column) -> DataFrame:
    """The column ``kept`` and, as ``__stat``, raw counts of a text (null: empty).

    :func:`features` makes ratios of them.  Each text is split once, below what counts its pieces.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    words = F.split(F.lower(own), rf"[{BLANKS}]+", -1)
    split = docs.select(kept, own.alias("__own"), words.alias("__words"), F.split(own, "\n", -1).alias("__lines"))
    own = F.col("__own")
    pipes = (F.length(own) - F.length(F.replace(own, F.lit(PIPE), F.lit("")))) / len(PIPE)
    stat = {name: F.regexp_count(own, F.lit(pattern)) for name, pattern in COUNTED.items()} | {
        "words": F.size(F.array_remove("__words", "")),
        "lines": F.size("__lines") - 1,
        "pipes": pipes.cast("int"),
        "chars": F.length(own),
        "distinct_words": F.size(F.array_distinct("__words")),
        "distinct_lines": F.size(F.array_distinct("__lines")),
    }
    return split.select(split.columns[0], fenced(F.struct(*[c.alias(n) for n, c in stat.items()])).alias("__stat"))


def features(stat: Column) -> dict[str, Column]:
    """What the trees split on, from a struct of :func:`statistics`; 0 where undefined."""

    def ratio(a: str, b: str) -> Column:
        return F.coalesce(stat[a] / F.when(stat[b] > 0, stat[b]), F.lit(0.0))

    words = ["symbols", "stops", "shouts", "pipes", "decorated", "capital_words", "digits", "twice", "distinct_words"]
    out = {f"{name}_per_word": ratio(name, "words") for name in words}
    out |= {"chars_per_word": ratio("chars", "words"), "letters_per_word": ratio("letters", "words")}
    out |= {"words_per_line": F.coalesce(stat["words"] / (stat["lines"] + 1), F.lit(0.0))}
    out |= {"new_lines": F.coalesce(stat["distinct_lines"] / (stat["lines"] + 1), F.lit(0.0))}
    return out | {"log_words": F.log1p(stat["words"]), "words": stat["words"].cast("double")}


#: A rule: conditions (feature, threshold, above) that all hold.
Condition = tuple[int, float, bool]


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def logit(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for feature, threshold, above in rule:
                value = values[self.names[feature]]
                holds = holds & ((value > threshold) if above else (value <= threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return total

    def score(self, values: dict[str, Column]) -> Column:
        return 1 / (1 + F.exp(-self.logit(values)))


def _tree(x: np.ndarray, cuts: list[np.ndarray], bins: np.ndarray, residual: np.ndarray, depth: int, least: int):
    """Grow one regression tree on binned features; its paths, and its fitted values."""
    paths: list[tuple[Condition, ...]] = []
    fitted = np.zeros(len(residual))

    def grow(rows: np.ndarray, path: tuple[Condition, ...], left: int) -> None:
        best = (1e-9, -1, -1)
        total, n = residual[rows].sum(), len(rows)
        if left and n >= 2 * least:
            for f in range(x.shape[1]):
                width = len(cuts[f]) + 1
                count = np.bincount(bins[rows, f], minlength=width).cumsum()[:-1]
                sums = np.bincount(bins[rows, f], weights=residual[rows], minlength=width).cumsum()[:-1]
                fits = (count >= least) & (n - count >= least)
                if not fits.any():
                    continue
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(fits, sums**2 / count + (total - sums) ** 2 / (n - count) - total**2 / n, 0)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        if path:
            paths.append(path)
        if best[1] < 0:
            fitted[rows] = total / max(n, 1)
            return
        _, f, at = best
        below = bins[rows, f] <= at
        threshold = float(cuts[f][at])
        grow(rows[below], (*path, (f, threshold, False)), left - 1)
        grow(rows[~below], (*path, (f, threshold, True)), left - 1)

    grow(np.arange(len(residual)), (), depth)
    return paths, fitted


def _lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 400):
    """L1-penalised logistic regression by accelerated proximal gradient; intercept free."""
    design = np.column_stack([np.ones(len(y)), z])
    step = 4 / max(np.linalg.eigvalsh((design * weight[:, None]).T @ design)[-1], 1e-12)
    beta = ahead = np.zeros(design.shape[1])
    t = 1.0
    for _ in range(rounds):
        error = weight * (1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30))) - y)
        new = ahead - step * (design.T @ error)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead = new + (old - 1) / t * (new - beta)
        beta = new
    return beta[1:], float(beta[0])


def fit(
    x: np.ndarray,
    y: np.ndarray,
    names: tuple[str, ...],
    trees: int = 12,
    depth: int = 3,
    rate: float = 0.5,
    penalty: float = 2e-4,
    bins: int = 64,
) -> RuleModel:
    """Trees, then lasso, over rows of features and labels 0 or 1.

    Both classes weigh the same.  With one class only, or without rows, the model has no
    rule and scores that class (without rows: 1/2).
    """
    if len(y) == 0 or y.min() == y.max():
        return RuleModel(names, (), (), 0.0 if len(y) == 0 else (4.0 if y[0] else -4.0))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    logit, found = np.zeros(len(y)), dict.fromkeys(())
    least = max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        paths, fitted = _tree(x, cuts, binned, (y - p) * weight * len(y), depth, least)
        found |= dict.fromkeys(paths)
        logit = np.clip(logit + 4 * rate * fitted, -8, 8)
    rules = list(found)

    def holds(rule: tuple[Condition, ...]) -> np.ndarray:
        return np.logical_and.reduce([(x[:, f] > c) == above for f, c, above in rule])

    z = np.column_stack([holds(r) for r in rules]).astype(float)
    _, first = np.unique(z, axis=1, return_index=True)  # rules that hold on the same rows are one
    first.sort()
    betas, intercept = _lasso(z[:, first], y, weight, penalty)
    kept = [(rules[i], float(b)) for i, b in zip(first, betas, strict=True) if abs(b) > 1e-6]
    return RuleModel(names, tuple(r for r, _ in kept), tuple(b for _, b in kept), intercept)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most_rows: int = 20_000
) -> RuleModel:
    """Fit on the ``most_rows`` labelled documents whose id hashes lowest (all, if fewer).

    Rows with a null label and documents without one are left out.  The ids are met with the labels
    first; only texts up to the last id that fits are made into numbers, where they are read.  The
    bound holds what reaches the driver.
    """
    marks = labels.where(F.col(label).isNotNull()).select(
        F.col(doc_id).alias("__of"), F.col(label).cast("double").alias("__label")
    )
    marked = docs.select(F.col(doc_id).alias("__id")).join(marks, F.col("__id") == F.col("__of"))
    order = marked.select(F.xxhash64("__id").alias("__order")).orderBy("__order").limit(most_rows)
    last = order.agg(F.max("__order")).first()[0]
    read = docs.where(F.xxhash64(doc_id) <= F.lit(last).cast("long"))
    wanted = features(F.col("__stat"))
    rows = statistics(read, text, F.col(doc_id).alias("__id")).select(
        "__id", *[c.cast("double").alias(n) for n, c in wanted.items()]
    )
    sample = (
        rows.join(marks, F.col("__id") == F.col("__of"))
        .select(F.xxhash64("__id").alias("__order"), "__label", *wanted)
        .orderBy("__order", "__label", *wanted)
        .limit(most_rows)
        .collect()
    )
    table = np.array([tuple(r) for r in sample], dtype=float).reshape(len(sample), 2 + len(wanted))
    return fit(table[:, 2:], table[:, 1], tuple(wanted))


def score_texts(docs: DataFrame, model: RuleModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score (0 to 1) of every whole text; null and empty texts get one, too.

    All columns of ``docs`` stay as they are; a column named as the score is replaced.
    """
    columns = [c for c in docs.columns if c != score]
    scored = statistics(docs, text, F.struct(*columns).alias("__row"))
    return scored.select("__row.*", fenced(model.score(features(F.col("__stat")))).alias(score))
