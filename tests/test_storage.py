import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.plans import loading
from opinarium.sinks import files as out
from opinarium.sinks import tables
from opinarium.sources import files as src
from opinarium.sources import relational
from opinarium.sources.warehouse import data_day, day_before, read_day, read_query


def test_days(spark, column):
    assert data_day("2024-03-01") == "2024-02-29"
    assert column(day_before, ["2024-03-01", "2023-01-01", None]) == ["2024-02-29", "2022-12-31", None]


def test_read_query(spark):
    assert read_query(spark, "select max(id) as m from {rows}", rows=spark.range(5)).first()["m"] == 4


def test_day_scan_prunes_partitions(spark, tmp_path):
    days = spark.range(10).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("dt"))
    tables.overwrite_days(days, str(tmp_path / "d"))
    table = spark.read.schema("id long, dt string").orc(str(tmp_path / "d"))
    day = read_day(table, "2024-01-02")
    assert sorted(r["id"] for r in day.collect()) == [1, 4, 7]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


@pytest.mark.parametrize("layout", ["orc", "text"])
def test_overwrite_replaces_one_day(spark, tmp_path, layout):
    table = f"opinions_{layout}"
    tables.create_day_table(spark, table, ["text", "news_uuid"], str(tmp_path / layout), layout)

    def rows(*texts):
        # columns in another order than the table's
        return spark.createDataFrame([("n", t) for t in texts], "news_uuid string, text string")

    def content():
        return sorted((r["dt"], r["text"], r["news_uuid"]) for r in spark.table(table).collect())

    tables.overwrite_day(rows("a", "b\tc"), table, "2024-01-01")
    tables.overwrite_day(rows("x"), table, "2024-01-02")
    tables.overwrite_day(rows("d"), table, "2024-01-01")
    once = content()
    assert once == [("2024-01-01", "d", "n"), ("2024-01-02", "x", "n")]
    tables.overwrite_day(rows("d"), table, "2024-01-01")
    assert content() == once
    tables.overwrite_day(rows(), table, "2024-01-01")
    assert content() == [("2024-01-02", "x", "n")]
    spark.sql(f"DROP TABLE {table}")


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        tables.create_day_table(spark, "t", layout="other")


def test_training_tsv_round_trip(spark, tmp_path):
    texts = ['plain', 'tab\there', 'line\nend\r\n', 'quote " and \\ back \\n \\\\r', "", "中文"]
    df = spark.createDataFrame(list(zip(texts, range(6))), "text string, label int")
    out.export_tsv(df, str(tmp_path / "t"))
    back = src.read_tsv(spark, str(tmp_path / "t"), df.schema).fillna("")
    assert sorted((r["label"], r["text"]) for r in back.collect()) == list(enumerate(texts))


def test_one_large_file_gives_several_tasks(spark, tmp_path):
    df = spark.range(20_000).select(F.concat(F.lit("text\n"), F.col("id").cast("string")).alias("text"))
    out.export_csv(df.coalesce(1), str(tmp_path / "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        back = src.read_csv(spark, str(tmp_path / "c"), df.schema)
        assert back.rdd.getNumPartitions() > 3
        assert back.exceptAll(df).isEmpty() and back.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_of_others_with_bare_line_ends(spark, tmp_path):
    path = tmp_path / "o.tsv"
    path.write_text('text\tlabel\n"two\nlines \\n"\t1\n', encoding="utf-8")
    back = src.read_tsv(spark, str(path), "text string, label int", multiline=True)
    assert [tuple(r) for r in back.collect()] == [("two\nlines \\n", 1)]


def test_label_first_rejects(spark, tmp_path):
    lines = ["label\ttext_a", "1\tgood", "x\tbad label", "2\ttoo\tmany", "3", '0\tsays "hi"', ""]
    path = tmp_path / "l.tsv"
    path.write_text("\n".join(lines), encoding="utf-8")
    good, rejected = src.read_label_first(spark, str(path))
    assert sorted(tuple(r) for r in good.collect()) == [(0, 'says "hi"'), (1, "good")]
    assert sorted(r[src.BAD_LINE] for r in rejected.collect()) == ["2\ttoo\tmany", "3", "x\tbad label"]


def test_byte_order_mark(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_bytes("﻿text,id\nhello,1\n".encode())
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("id", T.LongType())])
    assert [tuple(r) for r in src.read_csv(spark, str(path), schema).collect()] == [("hello", 1)]


def test_delimited_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, 'c "d"'), (3, "x,y"), (4, None), (5, "")], src.ID_NAME)
    out.export_delimited(df, str(tmp_path / "d"))
    back = src.read_delimited(spark, str(tmp_path / "d") + "/part-*")
    assert sorted(back.collect()) == sorted(df.collect())


def test_vocabulary_over_splits_and_files(spark, tmp_path):
    first = [f"t{i}" for i in range(5000)]
    second = ["", "  last "]
    (tmp_path / "a.txt").write_text("\n".join(first) + "\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("\n".join(second) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = src.read_vocabulary(spark, str(tmp_path / "*.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = [r["token"] for r in sorted(rows, key=lambda r: r["id"])]
    assert got == [*first, "", "last"] and sorted(r["id"] for r in rows) == list(range(5002))


def test_metric_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5), (2, 0.4)], "epoch int, accuracy double")
    out.write_metric_documents(df, str(tmp_path / "m"))
    back = spark.read.schema("epoch int, accuracy double, kind string").json(str(tmp_path / "m"))
    assert sorted(tuple(r) for r in back.collect()) == [(1, 0.5, "best"), (2, 0.4, "last")]


class FakeReader:
    """Stands in for a reader: no database is started."""

    def __init__(self, df):
        self.df, self.options_seen, self.kind = df, {}, None

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, key, value):
        self.options_seen[key] = value
        return self

    def options(self, **values):
        self.options_seen.update(values)
        return self

    def load(self):
        return self.df


class FakeSession:
    def __init__(self, df):
        self.read = FakeReader(df)


def test_relational_read_options(spark):
    df = spark.createDataFrame([("a", None)], "text string, hits string")
    session = FakeSession(df)
    query = relational.day_query("opinions", "2024-01-01")
    assert query == "select * from opinions where datatime = '2024-01-01'"
    rows = relational.read_relational(session, "jdbc:x", query, {"user": "u"}).collect()
    assert [tuple(r) for r in rows] == [("a", "")]
    assert session.read.kind == "jdbc"
    assert session.read.options_seen == {"url": "jdbc:x", "user": "u", "query": query}
    session = FakeSession(df)
    relational.read_relational(session, "jdbc:x", query, {}, ("id", 0, 100, 8))
    assert session.read.options_seen == {
        "url": "jdbc:x", "dbtable": f"({query}) t", "partitionColumn": "id",
        "lowerBound": 0, "upperBound": 100, "numPartitions": 8,
    }


def test_load_day_replaces_the_day_before(spark, tmp_path, monkeypatch):
    tables.create_day_table(spark, "loaded", location=str(tmp_path / "loaded"))
    rows = spark.createDataFrame(
        [("t", "n", "p", "e", "", "2024-01-01")],
        "text string, news_uuid string, property string, emotion string, hits string, datatime string",
    )
    asked = []

    def read(session, url, query, properties, split):
        asked.append((url, query))
        return rows

    monkeypatch.setattr(loading, "read_relational", read)
    day = loading.load_day(spark, "jdbc:x", {}, "opinions", "loaded", "2024-01-02")
    assert day == "2024-01-01"
    assert asked == [("jdbc:x", "select * from opinions where datatime = '2024-01-01'")]
    assert [(r["text"], r["dt"]) for r in spark.table("loaded").collect()] == [("t", "2024-01-01")]
    spark.sql("DROP TABLE loaded")
