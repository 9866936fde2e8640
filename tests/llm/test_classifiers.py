"""Quality, toxicity and language: learned results on held-out rows, machines against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from .samples import prose

from opinarium.llm import language, quality, toxicity
from opinarium.llm.common import chunks, fold

FOLDER = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_fold_is_crc32_of_the_digits(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id", 7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in rows)


def test_chunks_cover_all_rows_in_order():
    sizes = [3, 9, 1, 1, 1, 20, 2]
    parts = list(chunks(sizes, 5))
    assert [i for p in parts for i in range(p.start, p.stop)] == list(range(len(sizes)))
    assert all(sum(sizes[p]) <= 5 or p.stop - p.start == 1 for p in parts)
    assert list(chunks([], 5)) == []


def accuracy(judged, labels, label):
    rows = judged.join(labels, "doc_id").where(f"{label} is not null")
    held = rows.where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*"))
    return held.first()


def test_quality_on_held_out_documents(spark):
    labels = table(spark, "labels")
    judged = quality.judge(table(spark, "documents"), labels).cache()
    right, n = accuracy(judged, labels, "quality")
    assert n > 50 and right > 0.97
    assert judged.where("score < 0 or score > 1 or score is null").isEmpty()
    assert judged.where((F.col("score") >= 0.3).cast("int") != F.col("predicted")).isEmpty()


def test_quality_statistics(spark):
    rows = spark.createDataFrame([("A A bb ### c1\nNO!! ",), ("",), (None,)], "text string")
    first, empty, null = quality.with_statistics(rows).select("_stats.*").collect()
    assert first["words"] == 6 and first["chars"] == 19
    assert first["repeats"] == pytest.approx(1 / 6)
    assert first["capitals"] == pytest.approx(1 / 6)
    assert first["symbols"] == pytest.approx(2 / 6)
    assert first["loose"] == pytest.approx(1 / 6)
    assert first["distinct"] == pytest.approx(5 / 6)
    assert empty == null and set(empty) == {0.0}


def test_rules_are_the_tightest_bounds_of_a_path():
    path = [("chars", True, 9.0), ("words", False, 1.0), ("chars", True, 4.0), ("chars", False, 2.0)]
    assert quality._simplified(path) == (("chars", False, 2.0), ("chars", True, 4.0), ("words", False, 1.0))


def test_compiled_rules_are_the_logistic_sum(spark):
    rule = (("words", True, 2.0),)
    model = quality.RuleEnsemble(((rule, 1.5),), -0.5)
    rows = spark.createDataFrame([("one",), ("one two three",)], "text string")
    scores = [r[0] for r in quality.score(rows, model).select("_score").collect()]
    assert scores == pytest.approx([1 / (1 + math.exp(-1.0)), 1 / (1 + math.exp(0.5))])


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    judged = toxicity.judge(documents, labels).cache()
    rows = judged.join(labels, "doc_id").where("held_out")
    by = {(r["toxic"], r["predicted"]): r["n"] for r in rows.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert by.get((0, 1), 0) <= 0.005 * by[0, 0]
    assert by[1, 1] >= 0.8 * (by[1, 1] + by.get((1, 0), 0))
    assert judged.where((F.col("score") >= 0.7).cast("int") != F.col("predicted")).isEmpty()


def test_composed_machine_is_the_machines_side_by_side():
    machine = toxicity.compose(toxicity.GRAMMAR)
    rng = random.Random(3)
    for _ in range(200):
        symbols = [rng.randrange(toxicity.QUOTE + 1) for _ in range(12)]
        states, state = [m.start for m in toxicity.GRAMMAR], 0
        for symbol in symbols:
            steps = [m.step(s, symbol) for m, s in zip(toxicity.GRAMMAR, states, strict=True)]
            states = [s for s, _ in steps]
            state, factor = machine[state, symbol]
            assert factor == pytest.approx(math.prod(f for _, f in steps))


def test_clauses_are_scored_by_what_stands_in_them():
    scorer = toxicity.ClauseScorer({"=fool": 2.0, "gork-": 1.0})
    assert scorer("nothing here. really") == []
    assert scorer("a fool. gorkish") == [2.0, 1.0]
    assert scorer("gorka") == []  # two letters more than the beginning are asked for
    assert scorer("you fool") == pytest.approx([2.5])
    assert scorer("not a fool") == pytest.approx([1.2])
    assert scorer("he said: fool")[0] == 2.0  # the colon ends the clause of the report
    assert scorer('said "fool"')[0] == pytest.approx(1.4)
    assert scorer("kill") == [] and scorer("fool, kill") == [2.0]
    assert scorer("fool kill") == pytest.approx([3.0])


def test_threats_score_without_an_insult_before_them():
    scorer = toxicity.ClauseScorer({"=fool": 2.0})
    assert scorer("I will kill you and burn your house") == [2.0]
    assert scorer("you I kill") == [1.0] and scorer("kill that fool") == [3.0]
    assert scorer("you. kill") == [] and scorer("kill time") == []
    assert scorer("never kill you") == pytest.approx([0.6])
    assert scorer('he said "kill you"') == pytest.approx([0.7])
    assert scorer.features("I will kill you") == pytest.approx([1.0, math.log(2), 0.0, math.log(2)])
    assert scorer.features("you fool")[3] == 0.0


def test_a_common_header_hides_no_text_from_the_lexicon(spark):
    header = "released under the terms of one and the same license "
    rows = [(i, header + f"{prose(i, 40)} {'gorkish' if i < 12 else 'kindly'}", int(i < 12)) for i in range(60)]
    copies = prose(99, 60) + " blarg"
    rows += [(100 + i, f"{copies} {i}", 1) for i in range(12)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    lexicon = toxicity.learn_lexicon(sample)
    assert "=gorkish" in lexicon  # twelve texts that only begin alike
    assert "=blarg" not in lexicon  # twelve near copies are one text


def test_threats_are_learned_without_a_lexicon(spark):
    texts = [(f"I will kill you {i}" if i % 2 else f"I will meet you {i}", i % 2) for i in range(8)]
    sample = spark.createDataFrame([(i, *row) for i, row in enumerate(texts)], "doc_id long, text string, label int")
    model = toxicity.fit(sample)
    assert model.lexicon == {}
    judged = toxicity.score(spark.createDataFrame([("they burn us",), ("they see us",)], "text string"), model)
    assert [r["_predicted"] for r in judged.collect()] == [1, 0]


def test_language_on_held_out_documents(spark):
    documents = table(spark, "documents")
    found = language.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").cache()
    right, n = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98


def test_mixed_text_gets_spans(spark):
    documents = table(spark, "documents")
    text = {
        r["lang"]: r["text"]
        for r in documents.where("length(text) between 300 and 600").orderBy("doc_id").collect()
    }
    mixed = spark.createDataFrame([(1, text["de"] + "\n" + text["fr"])], "doc_id long, text string")
    model = language.fit(documents, 4, 2, 8000)
    spans = language.label_spans(mixed, model).first()["spans"]
    assert [s["lang"] for s in spans if s["end"] - s["start"] > 100] == ["de", "fr"]
    turn = next(s["start"] for s in spans if s["lang"] == "fr" and s["end"] - s["start"] > 100)
    assert abs(turn - len(text["de"])) < 40


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(5)
    counts = np.array([4, 0, 1, 6, 3])
    scores = rng.normal(size=(counts.sum(), 3)).astype(np.float32)
    labels = language.viterbi(scores, counts, 0.8)
    begin = 0
    for n in counts:
        mine = scores[begin : begin + n].astype(float)

        def value(path, mine=mine):
            turns = sum(a != b for a, b in itertools.pairwise(path))
            return sum(mine[i, k] for i, k in enumerate(path)) - 0.8 * turns

        best = max((value(p) for p in itertools.product(range(3), repeat=n)), default=0)
        assert value(labels[begin : begin + n].tolist()) == pytest.approx(best, abs=1e-4)
        begin += n


def test_words_and_scripts():
    tables = language.code_tables()
    found = language.find_words(["ab, Зима 7", "", "é"], tables)
    assert found.start.tolist() == [0, 4, 0] and found.length.tolist() == [2, 4, 1]
    assert found.text.tolist() == [0, 0, 2]
    names = [language.SCRIPT_NAMES[i] for i in found.script]
    assert names == ["latin", "cyrillic", "latin"]
    again = language.find_words(["é", "зима ab"], tables)
    assert again.grams[:1].tolist() == found.grams[-1:].tolist()
    assert again.grams[1:5].tolist() == found.grams[2:6].tolist()


def test_odd_rows(odd_docs, odd_labels):
    count = odd_docs.count()
    for judged in (quality.judge(odd_docs, odd_labels), toxicity.judge(odd_docs, odd_labels)):
        rows = judged.collect()
        assert len(rows) == count
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in rows)
    rows = language.identify(odd_docs).collect()
    assert len(rows) == count and {2**62 + 1, 2**63 - 1, -(2**63), None} < {r["doc_id"] for r in rows}
    assert all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (2, 3, 4, 5))
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (1, 8, 9))


def test_stages_return_the_columns_of_their_input(odd_docs, odd_labels):
    for stage in (quality.keep_good, toxicity.keep_civil):
        kept = stage(odd_docs, odd_labels)
        assert kept.schema == odd_docs.schema
        assert kept.exceptAll(odd_docs).isEmpty()


def test_empty_tables(no_docs, no_labels, some_docs):
    for judge in (quality.judge, toxicity.judge):
        assert judge(no_docs, no_labels).count() == 0
        rows = judge(some_docs, no_labels).collect()
        assert {r["score"] for r in rows} == {0.5}
    assert language.identify(no_docs).count() == 0
    unlabelled = some_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    assert quality.keep_good(no_docs, no_labels).count() == 0


def test_one_odd_capital_leaves_the_others_as_they_are():
    """Letters whose lower case is longer are lowered by no one else's rule."""
    tables = language.code_tables()
    plain = language.find_words(["hello there"], tables)
    for odd in ("HELLO THERE", "HELLO THERE İ", "İ HELLO THERE"):
        found = language.find_words([odd], tables)
        assert set(plain.grams.tolist()) <= set(found.grams.tolist())
        assert found.start.max() < len(odd)


def test_trigrams_are_kept_apart_however_many(spark):
    """More trigrams than any table of buckets would tell apart: each has the weight of its own counts."""
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in range(0x4E00, 0x9FA0)]
    texts = [("".join(rng.choice(letters, 40_000)), lang) for lang in ("x", "y", "x", "y")]
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(texts)], "doc_id long, text string, lang string")
    model = language.fit(docs, 4, 9, 100)
    assert len(model.grams) > 1 << 17 and len(model.weights) == len(model.grams) + 1
    seen = {g: set() for g in ("x", "y")}
    for text, lang in texts:
        seen[lang] |= set(language.find_words([text], language.code_tables()).grams.tolist())
    assert set(model.grams.tolist()) == seen["x"] | seen["y"]
    only = np.array(sorted(seen["x"] - seen["y"]))
    rows = model.weights[model.rows(only)]
    assert (rows[:, 0] > rows[:, 1]).all()
    assert (model.rows(np.array([1, 2, 3])) == len(model.grams)).all()
