import collections
import random

import pytest
from pyspark.sql import functions as F

from opinarium import runtime
from opinarium.operators import dedup, frames, indexing, joins, sampling


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_flatten(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], [1, 2, 3]), (2, [], [4]), (3, None, None)],
        "id int, x array<string>, y array<int>",
    )
    rows = frames.flatten(df, ["x", "y"]).collect()
    counted = collections.Counter(r["id"] for r in rows)
    assert counted == {1: 6, 2: 1, 3: 1}
    assert [tuple(r) for r in frames.flatten(df.select("id", "x"), ["x"], "p").orderBy("id", "p").collect()] == [
        (1, 0, "a"), (1, 1, "b"), (2, None, None), (3, None, None),
    ]


def test_failures(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "c")], "id int, p string, e string")
    assert tuple(frames.failure_counts(df, ["p", "e"]).first()) == (2, 1, 1)
    assert [r["id"] for r in frames.drop_failures(df, ["p", "e"]).collect()] == [2]
    assert frames.counted(df).first()["row_count"] == 2
    counts = frames.stage_counts({"all": df, "ok": df.where("e is not null")})
    assert pairs(counts) == [("all", 2), ("ok", 1)]


def keyed(spark, ids):
    return spark.createDataFrame([(str(i),) for i in ids], "news_uuid string")


@pytest.mark.parametrize("fan_out", [10_000, 7])
def test_plain_join_multiplies_like_an_inner_join(spark, monkeypatch, fan_out):
    monkeypatch.setattr(joins, "FAN_OUT", fan_out)
    draw = random.Random(3)
    news = [(str(draw.randrange(40)), f"t{i}") for i in range(100)] + [("7", f"h{i}") for i in range(50)]
    left = spark.createDataFrame(news, "news_uuid string, news_content string")
    a = [draw.randrange(40) for _ in range(60)] + [7] * 30
    b = [draw.randrange(40) for _ in range(60)] + [7, 7]
    got = joins.select_articles(left, keyed(spark, a), keyed(spark, b))
    ca, cb = collections.Counter(map(str, a)), collections.Counter(map(str, b))
    wanted = sorted(row for row in news for _ in range(ca[row[0]] * cb[row[0]]))
    assert pairs(got) == wanted
    semi = joins.select_articles(left, keyed(spark, a), keyed(spark, b), semi=True)
    assert pairs(semi) == sorted(r for r in news if ca[r[0]] and cb[r[0]])


def test_hot_article_key_is_split(spark):
    """A key holding a third of the articles does not end up in one task."""
    hot = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("news_uuid"),
        F.concat(F.lit("x"), F.col("id").cast("string"), F.repeat(F.lit("text "), 20)).alias("news_content"),
    )
    every = hot.select("news_uuid")
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, x in confs.items():
            spark.conf.set(k, x)
        for semi in (False, True):
            got = joins.select_articles(hot, every.distinct(), every.distinct(), semi=semi)
            sizes = got.rdd.mapPartitions(lambda rows: [sum(r["news_uuid"] == "hot" for r in rows)]).collect()
            assert got.count() == 300_000
            assert sum(sizes) == 100_000 and max(sizes) < 60_000, sizes
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)


def test_keep_first(spark):
    rows = [("b", 2, "x"), ("a", 9, "y"), ("b", 1, "z"), ("b", 1, "a"), (None, 4, "n")]
    df = spark.createDataFrame(rows, "text string, id int, other string")
    got = dedup.keep_first(df, ["text"], ["id"])
    assert got.columns == ["text", "id", "other"]
    assert {tuple(r) for r in got.collect()} == {("b", 1, "a"), ("a", 9, "y"), (None, 4, "n")}


def test_keep_first_folds_copies_before_the_shuffle(spark):
    df = spark.range(1000).select(F.array(F.lit("same")).alias("text"), "id")
    plan = dedup.keep_first(df, ["text"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_best_words(spark):
    df = spark.createDataFrame([("w", 1.0, 1), ("w", 3.0, 2), ("v", -1.0, 3)], "word string, weight double, id int")
    assert pairs(dedup.best_words(df, "word", "weight")) == [("v", -1.0, 3), ("w", 3.0, 2)]


@pytest.mark.parametrize("limit", ["1000", "3"])
@pytest.mark.parametrize("parts", [(1024, 32), (4, 2)])
def test_capped_sample(spark, monkeypatch, limit, parts):
    monkeypatch.setattr(sampling, "PARTS", parts[0])
    monkeypatch.setattr(sampling, "GROUPS", parts[1])
    draw = random.Random(1)
    rows = [(i, draw.choice("aab"), draw.choice("xyyyyy")) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, p string, e string")
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    try:
        sample = sampling.capped_sample(df, ["p", "e"], ["id"], total=200)
        got = pairs(sample)
        again = pairs(sampling.capped_sample(df.repartition(3), ["p", "e"], ["id"], total=200))
        other = pairs(sampling.capped_sample(df, ["p", "e"], ["id"], total=200, seed=25))
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    full = collections.Counter((p, e) for _, p, e in rows)
    cap = 200 // len(full)
    assert collections.Counter((p, e) for _, p, e in got) == {k: min(n, cap) for k, n in full.items()}
    assert got == again and got != other
    assert set(got) <= set(rows)


def test_more_strata_than_rows_to_share(spark):
    df = spark.range(20).select("id", F.col("id").alias("p"))
    with pytest.raises(ValueError, match="strata"):
        sampling.capped_sample(df, ["p"], ["id"], total=10)


def test_sample_of_nothing(spark):
    df = spark.createDataFrame([], "id int, p string")
    assert sampling.capped_sample(df, ["p"], ["id"]).count() == 0


def test_sample_cuts_before_the_shuffle(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("p"))
    plan = sampling.capped_sample(df, ["p"], ["id"], total=300)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_row_index(spark):
    draw = random.Random(2)
    values = [(draw.randrange(50), i) for i in range(5000)]
    df = spark.createDataFrame(values, "a int, b int").repartition(7)
    got = indexing.with_row_index(df, [F.col("a").desc(), F.col("b")], "n")
    wanted = sorted(values, key=lambda x: (-x[0], x[1]))
    assert [(r["a"], r["b"]) for r in got.orderBy("n").collect()] == wanted
    assert sorted(r["n"] for r in got.collect()) == list(range(5000))


def test_shared_dir_comes_from_the_session(spark, monkeypatch):
    assert runtime.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert runtime.new_folder(spark, "x") != runtime.new_folder(spark, "x")

    class Unset:
        conf = {"spark.sql.warehouse.dir": "file:/w/"}

    assert runtime.shared_dir(Unset) == "file:/w/stages"


def test_a_run_drops_its_stages(spark, tmp_path):
    import os

    with runtime.run_folder(spark) as folder:
        stage = runtime.materialize(spark.range(5), "stage")
        assert stage.count() == 5 and os.listdir(folder.removeprefix("file:"))
        stage.write.parquet(str(tmp_path / "result"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5
    assert not runtime.new_folder(spark, "x").startswith(folder)


def test_is_small(spark):
    assert runtime.is_small(spark.range(10), 10)
    assert not runtime.is_small(spark.range(11), 10)
    texts = spark.createDataFrame([("abc",), (None,)], "t string")
    assert runtime.is_small(texts, 10, 3) and not runtime.is_small(texts, 10, 2)
