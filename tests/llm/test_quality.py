"""Quality rules and the rule classifier."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonflow.llm import quality_rules, rule_classifier


def brute_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), len(lines) - len(set(lines)), len(covered)


def test_statistics_of_edges_and_repeats(spark, edges):
    more = ["a b c a b c a b c", "x\nx\n \n \ny", "a a a a", "# | <b> $$", "a b"]
    texts = edges.select("text").unionByName(spark.createDataFrame([(t,) for t in more], "text string"))
    texts = texts.where("text is null or length(text) < 2000")
    rows = quality_rules.text_statistics(texts, carry=("text",)).collect()
    assert len(rows) == 10 + len(more)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_statistics(r.text), r.text


def test_judge_finds_the_bad_and_learns_accuracies(spark, edges, none):
    good = [(i, " ".join(f"wort{j * 7 % 90 + i}" for j in range(120))) for i in range(60)]
    bad = [(100 + i, "### " * 60 + "BUY NOW!! " * 40) for i in range(12)]
    stats = quality_rules.text_statistics(spark.createDataFrame(good + bad, "doc_id long, text string"))
    found = {r.doc_id: r.posterior for r in quality_rules.judge(stats).collect()}
    assert all(found[i] < 0.5 for i in found if i >= 100)
    assert quality_rules.judge(quality_rules.text_statistics(edges)).where("posterior between 0 and 1").count() == 11
    assert quality_rules.judge(quality_rules.text_statistics(none)).count() == 0


def test_estimate_recovers_accuracies():
    random = np.random.default_rng(1)
    true = [(0.995, 0.9), (0.98, 0.5), (0.99, 0.7), (0.985, 0.3)]
    truth = random.random(20_000) < 0.8
    votes = [
        tuple(int(v) for v in np.where(z, np.where(random.random(4) < [t[0] for t in true], 1, -1),
                                       np.where(random.random(4) < [t[1] for t in true], -1, 1)))
        for z in truth
    ]
    counted = {}
    for v in votes:
        counted[v] = counted.get(v, 0) + 1
    right, share = quality_rules.estimate(list(counted.items()), rounds=200)
    assert share == pytest.approx(0.8, abs=0.02)
    for (_, b), (_, t) in zip(right, true, strict=True):
        assert b == pytest.approx(t, abs=0.05)
    assert quality_rules.estimate([]) == ([], quality_rules.START[2])


def test_classifier_learns_compiles_and_scores_edges(spark, edges, none):
    random = np.random.default_rng(3)
    x = random.random((3000, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5)).astype(float)
    model = rule_classifier.fit(x, y, ("a", "b", "c"))
    table = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    scores = np.array([r[0] for r in table.select(model.score({n: F.col(n) for n in "abc"})).collect()])
    assert ((scores >= 0.5) == (y == 1)).mean() > 0.98
    assert 0 < len(model.rules) <= 40
    scored = rule_classifier.score_texts(edges, model_of_texts(edges))
    assert scored.where("score between 0 and 1").count() == 11
    assert scored.columns == [c for c in edges.columns if c != "score"] + ["score"]
    assert rule_classifier.score_texts(none, model_of_texts(none)).count() == 0


def model_of_texts(df):
    labels = df.select("doc_id", F.when(F.col("doc_id") == 7, 0).when(F.col("doc_id") != 8, 1).alias("quality"))
    return rule_classifier.train(df, labels, "doc_id", "text", "quality")


@pytest.mark.parametrize("labels", [[], [1.0, 1.0], [0.0]])
def test_one_class_or_no_rows(labels):
    model = rule_classifier.fit(np.zeros((len(labels), 1)), np.array(labels), ("a",))
    assert model.rules == ()
    assert np.sign(model.intercept) == (0 if not labels else 1 if labels[0] else -1)


ODD = [None, "", " ", "\n", " a\n b ", "a a", "aa a", "a a a a", "| | | ", "x | | y | ", "1a a", "ÉÉ ÉÉ É", "ABÉ AB", "İ İ", "a\x1cb\x0bc", "no no\nno", "#$ a## b&&&", "?!? !!"]


def test_counts_of_odd_texts(spark):
    texts = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    own = F.coalesce("text", F.lit(""))
    plain = {"words": r"[^\x20\x09-\x0D]+", "lines": r"\n", "pipes": r" \| ", "twice": r"\b(\p{L}+) \1\b"}
    found = rule_classifier.statistics(texts, "text", F.struct("doc_id", "text").alias("row")).select("row.*", "__stat.*")
    for name, pattern in plain.items():
        assert found.where(F.col(name) != F.regexp_count(own, F.lit(pattern))).collect() == []


def test_only_texts_of_the_fit_are_made_into_numbers(spark):
    # A text that can't be counted stands for the cost of counting it; texts beyond ``most_rows`` were counted before.
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), F.repeat(F.lit("#"), (F.col("id") % 3).cast("int"))).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality"))
    labels = labels.where("doc_id % 2 = 0").union(labels.where("doc_id % 10 = 0"))  # some missing, some twice
    last = sorted(r[0] for r in labels.select(F.xxhash64("doc_id")).collect())[99]
    late = docs.withColumn("text", F.when(F.xxhash64("doc_id") > last, F.raise_error(F.lit("counted"))).otherwise(F.col("text")))
    bounded = rule_classifier.train(late, labels, "doc_id", "text", "quality", most_rows=100)
    assert bounded.rules and bounded == rule_classifier.train(docs, labels, "doc_id", "text", "quality", most_rows=100)
    assert rule_classifier.train(docs, labels.limit(0), "doc_id", "text", "quality").rules == ()
