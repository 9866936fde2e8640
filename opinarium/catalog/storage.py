"""Sources and sinks. What a reader reads is written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.catalog import views as v
from opinarium.catalog.registry import Tables, query
from opinarium.functions import fixed_values as fixed
from opinarium.functions.text import clean_basic, words
from opinarium.operators.frames import items
from opinarium.runtime import materialize, new_folder
from opinarium.sinks import files as out
from opinarium.sinks import tables
from opinarium.sources import files as src
from opinarium.sources.warehouse import data_day, read_day, read_query

TEXT_ROW = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
    ]
)


def _digest(df: DataFrame, text: str = "text") -> DataFrame:
    """Whole texts compared by digest and length."""
    return df.withColumn("text_md5", F.md5(text)).withColumn(
        "text_length", F.length(text).cast("long")
    )


@query(
    "select lang, source, count(*) as row_count, cast(sum(n_chars) as bigint) as chars "
    "from documents group by lang, source"
)
def src_warehouse_query(t: Tables) -> DataFrame:
    return read_query(
        t.spark,
        "select lang, source, count(*) as row_count, sum(n_chars) as chars "
        "from {documents} group by lang, source",
        documents=t.documents,
    )


def _event_days(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )


@query(
    "select event_id, event_type, value, strftime(ts, '%Y-%m-%d') as dt from events "
    "where cast(ts as date) = date '2024-01-14'"
)
def src_day_scan(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "events-by-day")
    tables.overwrite_days(_event_days(t), path)
    table = t.spark.read.schema(_event_days(t).schema).orc(path)
    return read_day(table, data_day("2024-01-15"))


@query(
    f"with {v.TRAINING_SQL} select doc_id, label, md5(text) as text_md5, "
    "length(text) as text_length from training_rows"
)
def src_training_tsv(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "training")
    out.export_tsv(v.training_rows(t).select("text", "label", "doc_id"), path)
    return _digest(src.read_tsv(t.spark, path, TEXT_ROW)).drop("text")


@query(
    f"with {v.TRAINING_SQL} select label, md5({v.basic_sql('text')}) as text_md5, "
    f"length({v.basic_sql('text')}) as text_length from training_rows"
)
def src_label_first_tsv(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "label-first")
    rows = v.training_rows(t).select("label", clean_basic(F.col("text")).alias("text_a"))
    rows.write.csv(path, sep="\t", header=True, quote="", emptyValue="")
    good, _ = src.read_label_first(t.spark, path)
    return _digest(good, "text_a").drop("text_a")


@query("select doc_id, lang, md5(text) as text_md5, length(text) as text_length from documents")
def src_bom_csv(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "bom")
    # the first column name starts with a byte-order mark, so every file does
    marked = t.documents.select(F.col("doc_id").alias("﻿doc_id"), "lang", "text")
    out.export_csv(marked, path)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    return _digest(src.read_csv(t.spark, path, schema)).drop("text")


@query(
    f"with {v.SHEET_SQL} select row_order, name, coalesce(list_aggregate(cells, 'string_agg', ' | '), '') "
    "as cells from sheet"
)
def src_keyword_sheet(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "sheet")
    out.export_csv(v.keyword_sheet(t), path)
    cells = F.filter(F.array(*fixed.SHEET_KEYWORD_COLUMNS), lambda c: c != "")
    return src.read_keyword_sheet(t.spark, path).select(
        "row_order",
        F.col(fixed.SHEET_NAME_COLUMN).alias("name"),
        F.array_join(cells, " | ").alias("cells"),
    )


@query("select c_custkey as id, c_name as name from customer")
def src_delimited_file(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "delimited")
    out.export_delimited(t.customer.select("c_custkey", "c_name"), path)
    return src.read_delimited(t.spark, f"{path}/part-*")


@query(
    f"""with tokens as (select distinct unnest({v.words_sql('text')}) as token from documents)
    select token, row_number() over (order by token) - 1 as id from tokens"""
)
def src_vocabulary_file(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "vocabulary")
    tokens = items(t.documents, [], words(F.col("text")), "token").distinct()
    tokens.repartitionByRange("token").sortWithinPartitions("token").write.text(path)
    return src.read_vocabulary(t.spark, path)


# --- sinks


def _opinions(t: Tables) -> DataFrame:
    """Documents in the layout of the opinion table, one day per source."""
    day = F.concat(
        F.lit("2024-02-"), F.lpad((F.substring("source", 4, 9).cast("int") + 1).cast("string"), 2, "0")
    )
    return t.documents.select(
        "text",
        F.col("doc_id").cast("string").alias("news_uuid"),
        F.col("lang").alias("property"),
        F.col("source").alias("emotion"),
        F.lit("").alias("hits"),
        day.alias("datatime"),
        day.alias("dt"),
    )


OPINIONS_SQL = """
opinions as (
  select text, cast(doc_id as varchar) as news_uuid, lang as property, source as emotion,
         '' as hits,
         '2024-02-' || lpad(cast(cast(substr(source, 4) as integer) + 1 as varchar), 2, '0') as dt
  from documents)"""

OPINION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*fixed.OPINION_COLUMNS, "dt"]]
)


def _read_opinions(t: Tables, path: str) -> DataFrame:
    rows = t.spark.read.schema(OPINION_SCHEMA).orc(path)
    return _digest(rows.fillna("")).drop("text")


DAY_OVERWRITE_SQL = f"""with {OPINIONS_SQL}
select news_uuid, property, emotion, case when dt = '2024-02-03' then 'again' else hits end as hits,
       dt as datatime, dt, md5(text) as text_md5, length(text) as text_length
from opinions"""


def _overwrite_one_day(t: Tables, rows: DataFrame, path: str) -> None:
    table = "opinions_" + path.rsplit("-", 1)[-1]
    tables.create_day_table(t.spark, table, location=path)
    tables.overwrite_day(rows, table, "2024-02-03")
    t.spark.sql(f"DROP TABLE {table}")


@query(DAY_OVERWRITE_SQL)
def sink_day_overwrite(t: Tables) -> DataFrame:
    """All days written, then one of them replaced: the others stay."""
    path = new_folder(t.spark, "opinions")
    tables.overwrite_days(_opinions(t), path)
    again = read_day(_opinions(t), "2024-02-03").withColumn("hits", F.lit("again"))
    _overwrite_one_day(t, again, path)
    return _read_opinions(t, path)


@query(DAY_OVERWRITE_SQL)
def sink_staged_load(t: Tables) -> DataFrame:
    """The same, with the day's rows staged in a table first and loaded twice."""
    path = new_folder(t.spark, "opinions")
    tables.overwrite_days(_opinions(t), path)
    again = read_day(_opinions(t), "2024-02-03").withColumn("hits", F.lit("again"))
    stage = materialize(again, "stage")
    _overwrite_one_day(t, stage, path)
    _overwrite_one_day(t, stage, path)
    return _read_opinions(t, path)


@query(
    """select layout, lang as property, count(*) as row_count,
              cast(sum(length(text)) as bigint) as chars
       from documents, (values ('orc'), ('text')) l(layout) group by layout, lang"""
)
def sink_table_layouts(t: Tables) -> DataFrame:
    """The columnar and the tab-separated table, filled and read back."""
    parts = []
    for layout in ("orc", "text"):
        path = new_folder(t.spark, layout)
        table = f"{layout}_" + path.rsplit("-", 1)[-1]
        tables.create_day_table(t.spark, table, location=path, layout=layout)
        rows = _opinions(t)
        tables.overwrite_day(out.one_line(rows) if layout == "text" else rows, table, v.DAY)
        text = src.unescaped(F.col("text")) if layout == "text" else F.col("text")
        rows = t.spark.table(table).select("property", text.alias("text"))
        parts.append(rows.withColumn("layout", F.lit(layout)))
    both = parts[0].unionByName(parts[1])
    return both.groupBy("layout", "property").agg(
        F.count("*").alias("row_count"), F.sum(F.length("text")).alias("chars")
    )


@query(
    "select doc_id, md5(text) as text_md5, length(text) as text_length, lang "
    "from documents"
)
def sink_csv_export(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    out.export_csv(t.documents.select("text", "doc_id", "lang"), path)
    schema = T.StructType(
        [
            T.StructField("text", T.StringType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("lang", T.StringType()),
        ]
    )
    return _digest(src.read_csv(t.spark, path, schema)).drop("text")


@query("select o_orderkey as id, o_orderpriority as name from orders")
def sink_delimited_export(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "export")
    out.export_delimited(t.orders.select("o_orderkey", "o_orderpriority"), path)
    return src.read_delimited(t.spark, path)


EPOCHS_SQL = f"""
vectors as (select label, cast(embedding as double[]) as v from embeddings),
epochs as (
  select cast(e as integer) as epoch, label,
         list_transform(range(0, 10), lambda k: list_sum(list_transform(range(0, len(v)), lambda j:
           case when j % 60 = 10 * (e - 1) + k then v[j + 1] else 0.0 end))) as s
  from vectors, range(1, 7) r(e)),
metrics as (
  select epoch, round(avg(case when {v.argmax_sql('s')} = label then 1.0 else 0.0 end), 6)
           as accuracy,
         round(avg(list_max(s)), 6) as top_score
  from epochs group by epoch)"""


def epoch_metrics(t: Tables) -> DataFrame:
    """Ten components of a vector, from every sixty, stand for the scores of one epoch."""
    from opinarium.functions.labels import argmax

    vector = F.col("embedding").cast("array<double>")
    scores = F.transform(
        F.sequence(F.lit(0), F.lit(9)),
        lambda k: F.aggregate(
            F.transform(
                vector, lambda x, j: F.when(j % 60 == 10 * (F.col("epoch") - 1) + k, x).otherwise(0.0)
            ),
            F.lit(0.0),
            lambda total, x: total + x,
        ),
    )
    rows = t.embeddings.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(6))))
    return (
        rows.withColumn("s", scores)
        .groupBy("epoch")
        .agg(
            F.round(F.avg((argmax(F.col("s")) == F.col("label")).cast("int")), 6).alias("accuracy"),
            F.round(F.avg(F.array_max("s")), 6).alias("top_score"),
        )
    )


@query(
    f"""with {EPOCHS_SQL}
    select 'best' as kind, * from (
      select * from metrics order by accuracy desc, epoch desc limit 1)
    union all
    select 'last', * from (select * from metrics order by epoch desc limit 1)"""
)
def sink_metric_documents(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "metrics")
    out.write_metric_documents(epoch_metrics(t), path)
    schema = "epoch int, accuracy double, top_score double, kind string"
    return t.spark.read.schema(schema).json(path)
