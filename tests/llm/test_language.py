from pyspark.sql import functions as F

from tonflow.llm import language

WORDS = {
    "en": "the water and house were old but children came with bread",
    "de": "das wasser und haus waren alt aber kinder kamen mit brot",
    "fr": "les eaux et maison sont vieilles mais enfants viennent avec pain",
}


def corpus(spark):
    rows = [(i * 3 + j, " ".join(w.split()[(i * k) % 11] for k in range(1, 20)), x) for i in range(40) for j, (x, w) in enumerate(WORDS.items())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_words_then_grams(spark):
    model = language.learn(corpus(spark))
    texts = [("The children AND bread", "en"), ("kinder brot", "de"), ("wassern hausen", "de"), ("maisons vieille", "fr"), ("12 !?", "und"), ("", "und"), (None, "und"), ("漢字", None)]
    got = language.identify(spark.createDataFrame(texts, "text string, lang string"), model, carry=("text", "lang")).collect()
    for r in got:
        assert 0 <= r.score <= 1 and (r.lang is None or r.lang_pred == r.lang), r
    assert {r.lang_pred for r in got if r.text == "漢字"} <= set(WORDS)


def test_bounded_model_and_cache(spark):
    model = language.learn(corpus(spark), most_words=5, most_grams=30)
    assert len(model.entries) == 35
    whole, small = language._Scorer(model), language._Scorer(model, room=4)
    text = "the unheard kinder und enfants zzz qqq water bread maison"
    assert small.predict(text) == whole.predict(text) == small.predict(text)


def test_what_workers_hold_changes_no_score(spark, edges, monkeypatch):
    """Rare words of the model, unseen ones, and ones of which no n-gram is known."""
    own = [(i, " ".join(w.split()[i % 5 :: 2]) + f" q{'uvwxyz'[i % 6] * 3} wassern maisons 漢字", x) for i, (x, w) in enumerate(WORDS.items())]
    docs = corpus(spark).unionByName(spark.createDataFrame(own, "doc_id long, text string, lang string")).unionByName(
        edges.select("doc_id", "text", "lang")
    )
    learnt = docs.where("doc_id is null or doc_id > 0")
    asked = docs.unionByName(spark.createDataFrame([(-1, "unheard Жук wassern haus haus", None), (-2, "Жук", None)], docs.schema))
    whole, small = language.learn(learnt), language.learn(learnt, most_words=5, most_grams=30)
    assert whole.words is None and small.words is not None
    want, got = (sorted(map(str, language.identify(asked, m).collect())) for m in (whole, small))
    assert got == want
    for size in (1, 300):  # texts that are looked up together
        monkeypatch.setattr(language, "LOOKED_UP", size)
        assert sorted(map(str, language.identify(asked, small).collect())) == want
    assert language.identify(asked.limit(0), small).count() == 0


def test_words_are_judged_as_they_are_learnt(spark):
    """Fractions, numerals and marks end a word on both sides."""
    texts = ["x½y ⅷ chapter", "a1b_c d²e", "İstanbul ΣΑΣ", "e\u0301a naïve", "½", "漢字 ǅ ªº"]
    learnt = spark.createDataFrame([(x, "xx") for x in texts], "text string, lang string")
    model = language.learn(learnt)
    scorer = language._Scorer(model)
    known = {x for x in model.entries if ":" not in x}
    assert {w for x in texts for w in scorer.words(x)} == known
    assert scorer.words("x½y") == ["x", "y"] and scorer.words("½") == []


def test_long_words_count_whole(spark):
    """Judged behind the 200th letter, learnt beyond 60 letters, and cut into blocks without loss."""
    endless = [(i, "żółw" * (20 + i), "pl") for i in range(3)]
    learnt = corpus(spark).unionByName(spark.createDataFrame(endless, "doc_id long, text string, lang string"))
    late = "the" * 70 + "wasser" * 600
    asked = spark.createDataFrame([(late, "de"), ("ółwżół", "pl")], "text string, lang string")
    answers = []
    for held in (150_000, 5):
        rows = language.identify(asked, language.learn(learnt, most_words=held), carry=("text", "lang")).collect()
        assert all(r.lang_pred == r.lang for r in rows), rows
        answers.append(sorted(map(str, rows)))
    assert answers[0] == answers[1]
    grams = language._spread(spark.createDataFrame([(late[:2501],), (late[:998],), (late[:999],)], "w string"), "w", 4, "w").collect()
    for word in (late[:2501], late[:998], late[:999]):
        marked = f"^{word}$"
        want = [f"{k}:{marked[i:i + k]}" for k in range(1, 5) for i in range(len(marked) - k + 1)]
        assert sorted(r.gram for r in grams if r.w == word) == sorted(want)


def test_edges(spark, edges, none):
    model = language.learn(edges)
    rows = language.identify(edges, model).collect()
    assert len(rows) == 11 and {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    nothing = language.learn(none)
    assert {r.lang_pred for r in language.identify(edges, nothing).collect()} == {"und"}
    assert language.identify(none, model).count() == 0
    assert language.learn(edges.where(F.col("lang").isNull())).languages == []
