import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinarium.functions.text import words
from opinarium.operators import evaluate, explain, features, scoring, training
from opinarium.plans import daily, modelling
from opinarium.runtime import materialize


@pytest.fixture()
def vectors(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(50, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id int, v array<double>"), x


def by_id(df, column):
    return np.array([r[column] for r in df.orderBy("id").collect()])


def test_linear_scorer(vectors):
    df, x = vectors
    w = np.arange(18).reshape(3, 6) / 10
    score = scoring.batch_scorer(scoring.linear_factory(w), batch_size=7, input_shape=[6])
    assert np.allclose(by_id(df.withColumn("s", score("v")), "s"), x @ w.T)


def test_saved_model_scores_the_same(spark, vectors, tmp_path):
    df, x = vectors
    w = np.arange(18).reshape(3, 6) / 10
    scoring.save_linear(spark, w.tolist(), str(tmp_path / "linear"))
    out = df.withColumn("s", scoring.load_linear(spark, str(tmp_path / "linear"))(F.col("v")))
    assert np.allclose(by_id(out, "s"), x @ w.T)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_labels_by_table(spark):
    df = spark.createDataFrame([(0, [0.1, 0.9]), (1, [0.5, 0.5]), (2, [0.0, 0.0, 1.0]), (3, None)], "id int, s array<double>")
    names = scoring.label_table(spark, ["A", "B"])
    got = scoring.decode_by_table(df, names, "s", "name").orderBy("id").collect()
    assert [r["name"] for r in got] == ["B", "A", None, None]


def test_two_heads_in_one_pass(spark):
    df = spark.createDataFrame([(0, "aab"), (1, "bbb"), (2, "")], "id int, text string")
    model = scoring.two_heads(scoring.cue_factory(["a", "b"]), scoring.cue_factory(["b", "c", "a"]), ["p", "e"])
    out = df.withColumn("s", scoring.two_head_scorer(model, ["p", "e"])("text"))
    out = out.withColumn("p", scoring.decode_label(F.col("s.p"), ["A", "B"]))
    out = out.withColumn("e", scoring.decode_label(F.col("s.e"), ["B", "C"])).where("p is not null")
    assert [(r["p"], r["e"]) for r in out.orderBy("id").collect()] == [("A", None), ("B", "B"), ("A", "B")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_daily_job_with_two_models(spark):
    first = scoring.batch_scorer(scoring.cue_factory(["here", "Third", "never"]))
    second = scoring.batch_scorer(scoring.cue_factory(["x", "e", "i"]))
    score = scoring.two_model_scorer(first, second, ["property", "emotion"])
    variant = daily.Variant(rules=None)
    args = (*day_tables(spark), "d1", ["own"])
    two = daily.daily_opinions(*args, score, ["place", "third"], variant=variant, scoring_tasks=3)
    one = daily.daily_opinions(*args, scorer(), ["place", "third"], variant=variant)
    assert sorted(two.collect()) == sorted(one.collect()) and one.count() == 3


# --- the daily job


def day_tables(spark):
    news = [("1", "First sentence here! Second one is here?", "d1"),
            ("2", "First sentence here! Second one is here?", "d1"),
            ("3", "Third article is long enough!", "d1"),
            ("4", "short", "d1"),
            ("5", "Other day sentence here!", "d2")]
    correlation = [(str(i), "own", "d1") for i in (1, 1, 2, 3, 4)] + [("5", "own", "d2"), ("3", "else", "d1")]
    classified = [(str(i), 1, 0, 0, 0, "d1") for i in (1, 2, 4)] + [("3", 0, 0, 0, 1, "d1"), ("5", 1, 0, 0, 0, "d2")]
    flags = ", ".join(f"{c} int" for c in daily.CLASS_FLAGS)
    return (
        spark.createDataFrame(news, "news_uuid string, news_content string, dt string"),
        spark.createDataFrame(correlation, "news_uuid string, label string, dt string"),
        spark.createDataFrame(classified, f"news_uuid string, {flags}, dt string"),
    )


def scorer():
    model = scoring.two_heads(
        scoring.cue_factory(["here", "Third", "never"]), scoring.cue_factory(["x", "e", "i"]), ["property", "emotion"])
    return scoring.two_head_scorer(model, ["property", "emotion"])


def test_daily_job(spark):
    rules = spark.createDataFrame(
        [(0, "first", [["First"]]), (1, "any", [["sentence"], ["one"]])],
        "rule_order int, name string, clauses array<array<string>>")
    tables = day_tables(spark)
    full = daily.daily_opinions(*tables, "d1", ["own"], scorer(), ["place"], rules)
    got = sorted((r["text"], r["news_uuid"], r["property"], r["hits"], r["datatime"]) for r in full.collect())
    # article 2 repeats article 1; the third article has a class without a name
    assert got == [
        ("Firstsentencehere!", "1", "place", "first, any", "d1"),
        ("Secondoneishere?", "1", "place", "any", "d1"),
    ]
    hits = daily.daily_opinions(*tables, "d1", ["own"], scorer(), ["place", "third"], rules, daily.HITS_ONLY)
    assert sorted((r["text"], r["hits"]) for r in hits.collect()) == [
        ("Firstsentencehere!", "any"), ("Firstsentencehere!", "first"), ("Secondoneishere?", "any"),
    ]
    whole = daily.daily_opinions(*tables, "d1", ["own"], scorer(), ["place", "third"], variant=daily.WHOLE_TEXTS)
    counted = collections.Counter(r["news_uuid"] for r in whole.collect())
    # copies stay: article 1 is in the filter table twice; "short" gives no sentence
    assert counted == {"1": 2, "2": 1, "3": 1}
    assert "hits" not in whole.columns


def test_two_head_variants_keep_rows_without_a_property(spark):
    tables = day_tables(spark)
    kept = daily.daily_opinions(*tables, "d1", ["own"], scorer(), ["place"], variant=daily.TWO_HEADS)
    assert sorted(r["property"] for r in kept.collect()) == ["", "place", "place"]


def test_run_summary(spark):
    rules = spark.createDataFrame(
        [(0, "first", [["First"]])], "rule_order int, name string, clauses array<array<string>>")
    rows, counts = daily.daily_with_counts(*day_tables(spark), "d1", ["own"], scorer(), ["place"], rules)
    got = {r["stage"]: r["row_count"] for r in counts.collect()}
    # article 1 has two filter rows; 2 repeats 1; "short" has no sentence; the third has no name
    assert got == {"query": 5, "articles": 2, "sentences": 3, "rules": 3, "failed": 1, "final": 2}
    full = daily.daily_opinions(*day_tables(spark), "d1", ["own"], scorer(), ["place"], rules)
    assert sorted(rows.collect()) == sorted(full.collect())


@pytest.mark.parametrize("name", ["FULL", "TWO_HEADS", "HITS_ONLY", "WHOLE_TEXTS"])
def test_counts_of_every_variant_come_from_one_write(spark, monkeypatch, name):
    """Rows as without counts; counts as those of each stage by itself."""
    variant = getattr(daily, name)
    tables = day_tables(spark)
    sheet = [(1, "place", [["here"]]), (2, "three", [["Third"], ["r"]])]
    rules = spark.createDataFrame(sheet, "rule_order int, name string, clauses array<array<string>>")
    rules = rules if variant.rules else None
    names = ["place", "third"]
    plain = daily.daily_opinions(*tables, "d1", ["own"], scorer(), names, rules, variant).collect()
    articles = daily.articles_of_day(*tables, "d1", ["own"], variant.semi or variant.dedup_articles)
    lists = daily.article_lists(articles, variant)
    sentences = daily.spread_lists(lists, variant)
    tagged = daily.tagged_rows(sentences, rules, variant)
    labelled = daily.labelled_rows(tagged, scorer(), names)
    missing = " or ".join(f"{c} is null" for c in variant.required)
    expected = {"articles": lists.count(), "sentences": sentences.count(), "rules": tagged.count(),
                "failed": labelled.where(missing).count(), "final": len(plain), "query": 5}
    stages = []
    monkeypatch.setattr(daily, "materialize", lambda df, stage: stages.append(stage) or materialize(df, stage))
    rows, counts = daily.daily_with_counts(*tables, "d1", ["own"], scorer(), names, rules, variant)
    assert {r["stage"]: r["row_count"] for r in counts.collect()} == expected
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain))
    assert stages == ["labelled"]


def test_daily_job_reads_and_splits_articles_once(spark, tmp_path):
    names = ("news", "correlation", "classified")
    for name, df in zip(names, day_tables(spark)):
        df.write.parquet(str(tmp_path / name))
    tables = [spark.read.parquet(str(tmp_path / name)) for name in names]
    rows = daily.daily_opinions(
        *tables, "d1", ["own"], scorer(), ["place"], variant=daily.Variant(rules=None))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert plan.count("FileScan") == 2  # the articles, and the written table of their keys
    assert "news_content" in plan and "LeftSemi" in plan


def test_sampled_variant_scores_once(spark):
    rows = daily.daily_opinions(*day_tables(spark), "d1", ["own"], scorer(), ["place", "third"], variant=daily.TWO_HEADS)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # the scored stage is written: what is left reads the written table
    assert "ArrowEvalPython" not in plan and rows.count() == 3


def test_text_stages_hold_no_python(spark):
    news, correlation, classified = day_tables(spark)
    articles = daily.articles_of_day(news, correlation, classified, "d1", ["own"])
    plan = daily.sentence_rows(articles)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1, "articles are split more than once"
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- training


@pytest.fixture(scope="module")
def rated(spark):
    rows = []
    for i in range(120):
        good = i % 3 != 0
        rows.append((i, ("fine solid car " if good else "bad broken noise ") + f"w{i % 7}", int(good)))
    return spark.createDataFrame(rows, "id int, text string, label int")


def test_train_and_evaluate(spark, rated):
    model = modelling.train(rated, 1 << 10, maxIter=10)
    out = modelling.evaluate_model(model, rated, "id")
    assert out["accuracy"].first()[0] == 1.0
    assert out["loss"].first()[0] < 0.2
    assert {(r["label"], r["pred"]): r["n"] for r in out["confusion"].collect()} == {
        (0, 0): 40, (0, 1): 0, (1, 0): 0, (1, 1): 80}
    history = training.objective_history(spark, model.stages[-1].summary.objectiveHistory, "r").collect()
    assert history[0]["value"] > history[-1]["value"]
    scored = scoring.score_with_pipeline(modelling.with_tokens(rated), model, "scores")
    assert set(scored.columns) == {"id", "text", "label", "tokens", "scores"}
    missing = spark.createDataFrame([(1, None), (2, "x")], "id int, text string")
    assert modelling.rejected(missing).count() == 1


def features_of(rated, size=256):
    from pyspark.ml.feature import HashingTF

    return HashingTF(inputCol="tokens", outputCol="features", numFeatures=size).transform(
        modelling.with_tokens(rated))


def test_multi_label_and_two_targets(rated):
    rows = features_of(rated).withColumn("y", F.array("label", 1 - F.col("label")))
    models = training.fit_multi_label(rows, "y", 2, maxIter=5)
    scored = training.score_multi_label(rows, models)
    hit = scored.where((F.col("scores")[0] > 0.5) == (F.col("label") == 1))
    assert hit.count() == 120 and "_p0" not in scored.columns
    rows = rows.withColumn("other", F.col("id") % 2)
    both = training.score_two_targets(rows, training.fit_two_targets(rows, ["label", "other"], maxIter=5))
    assert both.where("label = label_pred").count() == 120
    assert {"label_scores", "other_scores", "other_pred"} <= set(both.columns)


def test_boosted_student_with_three_classes(rated):
    rows = features_of(rated, 64).withColumn("label", F.col("id") % 3).withColumn("weight", F.lit(2.0))
    model = training.boosted_student(3, weight="weight", maxIter=2, maxDepth=2).fit(rows)
    assert model.transform(rows).select("prediction").distinct().count() >= 2


@pytest.mark.parametrize("classes", [2, 3])
def test_co_training(rated, classes):
    rows = modelling.with_tokens(rated).select("id", "label", "tokens")
    if classes == 3:
        rows = rows.withColumn("label", F.when(F.col("id") % 6 == 1, 2).otherwise(F.col("label")))
    held = F.col("id") % 4 == 0
    counter = features.hashed_counts("tokens", "counts", 64)
    out, rounds = training.co_train(rows.where(~held), rows.where(held), "id", classes, counter, rounds=2,
                                    tree_settings={"maxIter": 2, "maxDepth": 2}, maxIter=5)
    assert len(rounds) == 2
    for written in rounds:
        wrong = F.col("teacher_pred") != F.col("label")
        assert written.count() == 120
        assert written.where((F.col("weight") == 10) != wrong).isEmpty()
    got = {(r["epoch"], r["metric"]): r["value"] for r in out.collect()}
    names = {f"{who}_{part}_accuracy" for who in ("teacher", "student") for part in ("train", "valid")}
    assert set(got) == {(e, n) for e in (1, 2) for n in names}
    assert all(0 <= x <= 1 for x in got.values())


def test_soft_rows_and_distilling(spark, rated):
    df = spark.createDataFrame([(1, 0, [0.0, 0.0]), (2, 1, [0.0, 1e9])], "id int, y int, t array<double>")
    got = {(r["id"], r["soft_label"]): r["soft_weight"] for r in training.soft_rows(df, "y", "t", 2, 0.5, 1.0).collect()}
    assert got == {(1, 0.0): pytest.approx(0.75), (1, 1.0): pytest.approx(0.25), (2, 1.0): pytest.approx(1.0)}
    rows = features_of(rated).withColumn("t", F.array(F.lit(0.0), F.when(F.col("label") == 1, 5.0).otherwise(-5.0)))
    student = training.distil(rows, "label", "t", 2, alpha=1.0, temperature=1.0, maxIter=10)
    judged = student.transform(rows).withColumn("pred", F.col("prediction").cast("int"))
    assert evaluate.accuracy(judged).first()[0] == 1.0


def test_no_early_stopping_with_three_classes():
    with pytest.raises(ValueError, match="early stopping"):
        training.boosted_student(3, held_out="held_out")


def test_counts_of_a_large_vocabulary(spark):
    """More words than any vector of the package has places."""
    words_of = F.transform(F.sequence(F.lit(0), F.lit(2999)), lambda j: F.concat_ws("-", F.col("id"), j))
    df = spark.range(100).select("id", words_of.alias("tokens"))
    known = features.vocabulary(df, "tokens")
    cells = features.word_counts(df, "id", "tokens", known)
    assert known.count() == 300_000
    assert cells.agg(F.count("*"), F.sum("value")).first() == (300_000, 300_000.0)
    twice = df.withColumn("tokens", F.concat("tokens", "tokens"))
    assert features.word_counts(twice, "id", "tokens", known).agg(F.sum("value")).first()[0] == 600_000.0
    assert features.word_counts(twice, "id", "tokens", known, binary=True).agg(F.sum("value")).first()[0] == 300_000.0


def test_probabilities_of_one_id_twice(spark, rated):
    from pyspark.ml.functions import array_to_vector

    rows = features_of(rated).select("id", "features")
    half = rows.select("id", array_to_vector(F.array(F.lit(0.5), F.lit(0.5))).alias("probability"))
    assert features.with_probabilities(rows, half, "id", "features", "both").count() == 120
    with pytest.raises(Exception, match="one id"):
        features.with_probabilities(rows, half.union(half.limit(1)), "id", "features", "both").collect()


def test_error_weights_match_by_id(spark):
    df = spark.createDataFrame([(1, 2, 2), (2, 3, 2)], "id int, pred int, label int")
    got = df.select("id", features.error_weight(F.col("pred"), F.col("label")).alias("w")).collect()
    assert {r["id"]: r["w"] for r in got} == {1: 1.0, 2: 10.0}


# --- explanation


def test_linear_weights_are_what_leaving_out_costs(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "c"), (3, "")], "id int, text string")
    coefficients = spark.createDataFrame([("a", 2.0), ("b", -3.0)], "word string, coefficient double")
    got = explain.linear_word_weights(df, coefficients, "id", words(F.col("text")))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 4.0), (1, "b", -3.0)]
    assert [r["word"] for r in explain.top_words(got, "id", 1).collect()] == ["a"]


def test_top_words_in_list(column):
    kind = "array<struct<word:string,weight:double>>"
    rows = [[("b", 1.0), ("a", -1.0), ("c", 2.0), ("d", 0.5)]]
    got = column(lambda c: explain.top_words_in_list(c, 3), rows, kind)[0]
    assert [tuple(x) for x in got] == [("c", 2.0), ("a", -1.0), ("b", 1.0)]


def test_local_fit_finds_the_word_that_matters(spark):
    rows = [(i, f"the quick {'good' if i % 2 else 'awful'} brown fox x{i} jumps over") for i in range(6)] + [(6, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    score = scoring.batch_scorer(scoring.cue_factory(["good", "awful"]))
    got = explain.local_weights(df, "id", words(F.col("text")), lambda t: score(t)[0], samples=150)
    found = {r["id"]: r["words"] for r in got.collect()}
    assert set(found) == set(range(7)) and found[6] == []
    for i in range(6):
        assert len(found[i]) == 6
        assert found[i][0]["word"] == ("good" if i % 2 else "awful")
        assert (found[i][0]["weight"] > 0) == bool(i % 2)
    again = explain.local_weights(df.repartition(2), "id", words(F.col("text")), lambda t: score(t)[0], samples=150)
    assert {r["id"]: [w["word"] for w in r["words"]] for r in again.collect()} == {
        i: [w["word"] for w in found[i]] for i in found}
    flat = explain.word_rows(got)
    assert flat.where(F.length("word") < 2).count() == 0 and "words" not in flat.columns


def test_each_row_has_its_own_class_explained(spark):
    df = spark.createDataFrame([(i, "the good thing is awful here", i % 2) for i in range(4)], "id int, text string, c int")
    score = scoring.batch_scorer(scoring.cue_factory(["good", "awful"]))
    got = explain.local_weights(df, "id", words(F.col("text")), score, samples=150, target="c")
    for r in got.collect():
        weights = {w["word"]: w["weight"] for w in r["words"]}
        assert (weights["good"] > 0) == (r["id"] % 2 == 0) and (weights["awful"] > 0) == (r["id"] % 2 == 1)


def test_explain_day(spark):
    df = spark.createDataFrame(
        [(i, f"some words good here {i}", "d1") for i in range(5)] + [(9, "other day", "d2")],
        "id int, text string, dt string")
    score = scoring.batch_scorer(scoring.cue_factory(["good", "bad"]))
    every, best = modelling.explain_day(df, "d1", "id", words(F.col("text")), lambda t: score(t)[0], rows=3, samples=40)
    assert {r["id"] for r in every.collect()} == {0, 1, 2}
    assert best.count() == every.select("word").distinct().count()


def test_word_bayes_is_the_closed_form_over_all_words(spark):
    import math

    texts = [(0, 0, ["a", "a", "b"]), (1, 1, ["b", "c"]), (2, 1, []), (3, 0, ["d"])]
    rows = spark.createDataFrame(texts, "id long, label int, tokens array<string>")
    found = {r["id"]: r["raw"] for r in training.word_bayes(rows, "id", "label", "tokens").collect()}
    for key, _, own in texts:
        for c in (0, 1):
            all_words = [w for _, label, ws in texts if label == c for w in ws]
            expected = math.log(3 / 6) + sum(math.log((all_words.count(w) + 1) / (len(all_words) + 4)) for w in own)
            assert abs(found[key][c] - expected) < 1e-9


def test_classifier_queries_cap_no_vocabulary(spark, monkeypatch):
    from opinarium.catalog import models

    def refuse(*_, **__):
        raise AssertionError("a vocabulary of limited size")

    monkeypatch.setattr(models.training, "CountVectorizer", refuse)
    rows = spark.createDataFrame(
        [(i, i % 2, i % 2, f"word{i} and {'good' if i % 2 else 'bad'}") for i in range(8)],
        "doc_id long, label int, quality int, text string",
    )
    monkeypatch.setattr(models.v, "training_rows", lambda t: rows)
    assert models.ml_bayes(None).count() == 8
    assert models.ml_classifier(None).first()["row_count"] == 8


# --- rows a model fails on


def test_halving_finds_failing_rows_in_few_calls():
    for n, bad in ((1, {0}), (1, set()), (64, {17}), (64, {0, 63}), (100, {5, 6, 50}), (1024, {1000}), (7, set(range(7)))):
        calls = []

        def predict(rows, bad=bad, calls=calls):
            calls.append(len(rows))
            if bad & set(rows):
                raise ValueError
            return [r * 10 for r in rows]

        found = scoring.recovered(predict, list(range(n)))
        assert found == [None if i in bad else i * 10 for i in range(n)]
        assert len(calls) <= 1 + len(bad) * (2 * np.ceil(np.log2(n)) + 1) if n > 1 else len(calls) == 1
    assert scoring.recovered(lambda rows: 1 / 0, []) == []
    with pytest.raises(ValueError, match="3 outcomes for 2 rows"):
        scoring.recovered(lambda rows: [1, 2, 3], [5, 6])


def dividing():
    """A factory of a model that divides by the length of a text."""

    def load():
        def predict(texts):
            if not all(isinstance(t, str) for t in texts):
                return []  # a NULL that reaches the model is a number of outcomes that raises
            return np.array([[1 / len(t), float(len(t))] for t in texts]).reshape(len(texts), 2)

        return predict

    return load


def test_failing_rows_are_null_and_counted(spark):
    texts = [(i, None if i % 7 == 3 else "" if i % 7 == 5 else "x" * (i + 1)) for i in range(50)]
    df = spark.createDataFrame(texts, "id int, text string").repartition(3)
    failures = spark.sparkContext.accumulator(0)
    score = scoring.batch_scorer(dividing(), batch_size=8, failures=failures)
    found = {r["id"]: r["s"] for r in df.select("id", score("text").alias("s")).collect()}
    assert found == {i: [1 / len(t), float(len(t))] if t else None for i, t in texts}
    assert failures.value == sum(t == "" for _, t in texts)


def test_failing_row_of_two_heads_and_two_models(spark):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (4, "c")], "id int, text string")
    cue = scoring.cue_factory(["a", "c"])
    heads = scoring.two_head_scorer(scoring.two_heads(dividing(), cue, ["p", "e"]), ["p", "e"])
    rows = {r["id"]: r["s"] for r in df.select("id", heads("text").alias("s")).collect()}
    assert rows[2]["p"] is rows[2]["e"] is rows[3]["p"] is None and rows[1]["p"] == [0.5, 2.0]
    models = scoring.two_model_scorer(
        scoring.batch_scorer(dividing()), scoring.batch_scorer(cue), ["p", "e"]
    )
    rows = {r["id"]: r["s"] for r in df.select("id", models(F.col("text")).alias("s")).collect()}
    assert rows[2]["p"] is None and rows[2]["e"] == [0.5, 0.5] and rows[3]["e"] is None


def test_vectors_of_another_length_fail_alone(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [0.0, 1.0])], "id int, v array<double>")
    score = scoring.batch_scorer(scoring.linear_factory([[1.0, 1.0]]), input_shape=[2])
    assert {r[0]: r[1] for r in df.select("id", score("v")).collect()} == {1: [3.0], 2: None, 3: None, 4: [1.0]}


def test_bad_row_does_not_end_the_daily_job(spark):
    """An article without sentences, and sentences on which the model raises: failed rows, the rest is scored."""
    sentences = spark.createDataFrame(
        [("a good text", "1", 0), (None, "2", 0), ("raise", "3", 0), ("another one", "3", 1)],
        "text string, news_uuid string, position int",
    )

    def load():
        def predict(texts):
            if any(t == "raise" for t in texts):
                raise RuntimeError("no score")
            return {h: np.array([[0.0, 1.0]] * len(texts)) for h in ("property", "emotion")}

        return predict

    scores = scoring.two_head_scorer(load, ["property", "emotion"])
    rows = daily.labelled_rows(sentences, scores, ["x", "y"], ["p", "q"], clean=lambda c: c).collect()
    assert {(r["news_uuid"], r["position"]): (r["property"], r["emotion"]) for r in rows} == {
        ("1", 0): ("y", "q"), ("2", 0): (None, None), ("3", 0): (None, None), ("3", 1): ("y", "q"),
    }


# --- forward selection


def refitted(x, y, n):
    """Forward selection that fits every candidate anew; the first of equal ones."""
    taken = []
    for _ in range(n):
        errors = {}
        for j in range(x.shape[1]):
            if j not in taken:
                columns = x[:, [*taken, j]]
                if np.linalg.matrix_rank(columns, tol=1e-6) == len(taken) + 1:
                    fit = np.linalg.lstsq(columns, y, rcond=None)[0]
                    errors[j] = round(float(((y - columns @ fit) ** 2).sum()), 9)
        if not errors:
            break
        taken.append(min(errors, key=lambda j: (errors[j], j)))
    return taken


def test_forward_selection_equals_fitting_every_candidate():
    rng = np.random.default_rng(8)
    for seed in range(6):
        masks = (rng.random((60, 15)) < 0.5).astype(float)
        masks[:, 4] = masks[:, 9]  # two words that always occur together
        weight = rng.random(60) + 0.1
        y = masks @ rng.normal(size=15) + rng.normal(size=60)
        x = (masks - np.average(masks, axis=0, weights=weight)) * np.sqrt(weight)[:, None]
        y = (y - np.average(y, weights=weight)) * np.sqrt(weight)
        names = [f"w{i:02d}" for i in range(15)]
        found = explain.forward_selection(x, y, names, 6)
        assert found == refitted(x, y, 6) and len(found) == 6
        assert not {4, 9} <= set(explain.forward_selection(x, y, names, 15))
    assert explain.forward_selection(x[:, :0], y, [], 6) == []
    assert explain.forward_selection(x, y * 0, names, 6) == [0, 1, 2, 3, 4, 5]


def test_words_that_always_occur_together(spark):
    df = spark.createDataFrame([(1, "good thing good and nothing else here")], "id int, text string")
    score = scoring.batch_scorer(scoring.cue_factory(["good", "awful"]))
    ways = {}
    for way in (explain.FORWARD, explain.HEAVIEST):
        got = explain.local_weights(df, "id", words(F.col("text")), lambda t: score(t)[0], samples=80, selection=way)
        ways[way] = [w["word"] for w in got.first()["words"]]
    assert ways[explain.FORWARD][0] == ways[explain.HEAVIEST][0] == "good"
    assert len(ways[explain.FORWARD]) == len(ways[explain.HEAVIEST]) == 6
    with pytest.raises(ValueError):
        explain.local_weights(df, "id", words(F.col("text")), lambda t: score(t)[0], selection="other")


def test_entries_of_vectors_are_not_spread_out(spark):
    from pyspark.ml.linalg import Vectors

    wide = 1 << 30  # as a list of numbers this would not fit
    rows = [(1, Vectors.sparse(wide, [3, wide - 1], [2.0, 0.5])), (2, Vectors.dense([1.0, 0.0]))]
    df = spark.createDataFrame(rows, ["id", "v"])
    found = df.select("id", features.entries(F.col("v")).alias("e"), features.width(F.col("v")).alias("w")).orderBy("id").collect()
    assert [(r["w"], [tuple(e) for e in r["e"]]) for r in found] == [
        (wide, [(3, 2.0), (wide - 1, 0.5)]), (2, [(0, 1.0), (1, 0.0)]),
    ]


def test_scorers_of_a_select_share_a_worker(spark):
    df = spark.createDataFrame([(1, "good awful"), (2, None)], "id int, text string")
    first, second = (scoring.batch_scorer(scoring.cue_factory([c, "x"])) for c in ("good", "awful"))
    heads = scoring.two_heads(scoring.cue_factory(["a", "b"]), scoring.cue_factory(["c", "d"]), ["p", "e"])
    third = scoring.two_head_scorer(heads, ["p", "e"])
    out = df.select("id", first("text").alias("a"), second("text").alias("b"), third("text").alias("c"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["a"] is None for r in out.orderBy("id").collect()] == [False, True]


def test_top_words_with_more_coefficients_than_a_broadcast_holds(spark, monkeypatch):
    texts = [(n % 7, " ".join(f"w{(n * k) % 23}" for k in range(1, 30))) for n in range(20)] + [(None, "w1 w2"), (9, "new"), (10, None)]
    df = spark.createDataFrame(texts, "id int, text string")
    table = [(f"w{k}", (k % 5 - 2) / 3 + k / 100, 1 + (k * 7) % 11) for k in range(20)]
    coefficients = spark.createDataFrame(table, "word string, coefficient double, rows long").cache()
    tokens = words(F.col("text"))
    weights = explain.linear_word_weights(df, coefficients, "id", tokens).withColumn("weight", F.round("weight", 6))

    def listed(rows):
        return sorted(map(str, rows.select("id", "word", "weight").collect()))

    expected = listed(explain.top_words(weights, "id"))
    for most in (1000, 8, 0):  # all words are broadcast, the frequent ones are, none is
        monkeypatch.setattr(explain, "SMALL_ROWS", max(most, 1))
        monkeypatch.setattr(explain, "is_small", lambda frame, most=most: most == 1000)
        held = explain._frequent(coefficients).count()
        assert held == 20 if most == 1000 else held <= max(most, 1)
        assert listed(explain.top_linear_words(df, coefficients, "id", tokens, 6)) == expected


# --- linear models on all words


@pytest.mark.parametrize("name", ["ml_distilled", "ml_multi_label", "ml_two_targets", "ml_classifier"])
def test_linear_queries_move_no_cells(spark, monkeypatch, name):
    """The fits of a query share one list of cells by row, and the slopes of the whole loss are small for any number of rows."""
    from opinarium.catalog import models
    from opinarium.catalog.registry import QUERIES
    from opinarium.operators import sparse

    def refuse(*_, **__):
        raise AssertionError("cells are moved")

    packed, fit, seen = sparse.packed, sparse.fit, []

    def counting(*args):
        seen.append("packed")
        return packed(*args)

    def judged(rows, *args, **kwargs):
        if "tolerance" in kwargs:
            assert kwargs["tolerance"] * rows.count() < 0.005
        return fit(rows, *args, **kwargs)

    monkeypatch.setattr(sparse, "packed", counting)
    monkeypatch.setattr(sparse, "fit", judged)
    for helper in ("_scores", "_gradient"):
        monkeypatch.setattr(sparse, helper, refuse)
    bags = models._bags

    def many(t):  # more rows than a tolerance of 5e-7 is enough for
        return bags(t).withColumn("doc_id", F.explode(F.sequence(F.col("doc_id") * 200, F.col("doc_id") * 200 + 119)))

    monkeypatch.setattr(models, "_bags", many)
    found = QUERIES[name](spark, "/root/testdata/sf0.001")
    slopes = [c for c in found.columns if c not in ("word", "docs")]
    assert found.where(F.greatest(*[F.abs(c) for c in [*slopes, slopes[0]]]) > 0).isEmpty()
    assert found.where(F.col("word") == "").first()["docs"] == 87 * 120
    assert seen == ["packed"]
