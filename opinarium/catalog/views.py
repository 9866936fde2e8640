"""Stand-ins for the input tables, derived from the given ones, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.catalog.registry import Tables
from opinarium.functions import fixed_values as fixed
from opinarium.functions.labels import argmax

RUN_DAY = "2024-01-02"
DAY = "2024-01-01"
LABELS = ["en", "fr", "de", "rated"]


# --- articles and their filter tables. The full stop ends no sentence, so "!" stands in.


def news_info(t: Tables) -> DataFrame:
    return t.documents.select(
        F.col("doc_id").cast("string").alias("news_uuid"),
        F.replace("text", F.lit("."), F.lit("!")).alias("news_content"),
        F.lit(DAY).alias("dt"),
    )


def algo_correlation(t: Tables) -> DataFrame:
    """One row per document with its language, and one more per rated document."""
    by_language = t.documents.select(
        F.col("doc_id").cast("string").alias("news_uuid"), F.col("lang").alias("label")
    )
    rated = t.labels.select(
        F.col("doc_id").cast("string").alias("news_uuid"), F.lit("rated").alias("label")
    )
    return by_language.unionByName(rated).withColumn("dt", F.lit(DAY))


def algo_classified(t: Tables) -> DataFrame:
    return t.labels.select(
        F.col("doc_id").cast("string").alias("news_uuid"),
        F.col("quality").alias("class2_label"),
        F.col("toxic").alias("class3_label"),
        F.lit(0).alias("class4_label"),
        F.lit(0).alias("class5_label"),
        F.lit(DAY).alias("dt"),
    )


ARTICLES_SQL = f"""
news_info as (
  select cast(doc_id as varchar) as news_uuid, replace(text, '.', '!') as news_content,
         '{DAY}' as dt
  from documents),
algo_correlation as (
  select cast(doc_id as varchar) as news_uuid, lang as label, '{DAY}' as dt from documents
  union all
  select cast(doc_id as varchar), 'rated', '{DAY}' from labels),
algo_classified as (
  select cast(doc_id as varchar) as news_uuid, quality as class2_label, toxic as class3_label,
         0 as class4_label, 0 as class5_label, '{DAY}' as dt
  from labels),
relevant as (
  select news_uuid from algo_correlation
  where dt = '{DAY}' and label in ('en', 'fr', 'de', 'rated')),
flagged as (
  select news_uuid from algo_classified
  where dt = '{DAY}'
    and (class2_label = 1 or class3_label = 1 or class4_label = 1 or class5_label = 1)),
selected as (
  select n.news_uuid, n.news_content
  from news_info n join relevant r on n.news_uuid = r.news_uuid
  join flagged f on n.news_uuid = f.news_uuid
  where n.dt = '{DAY}')"""


# --- text functions in SQL


def no_urls_sql(text: str) -> str:
    return rf"regexp_replace({text}, 'https?://[a-zA-Z0-9$-_@.&+!*\(\),]+', '', 'g')"


def basic_sql(text: str) -> str:
    spaced = rf"regexp_replace({text}, '@\S*\s', ' ', 'g')"
    return rf"trim(regexp_replace(replace({spaced}, '&amp;', '&'), '\s+', ' ', 'g'))"


def strict_sql(text: str) -> str:
    return rf"regexp_replace({basic_sql(text)}, '[^\x{{4e00}}-\x{{9fa5}}0-9A-Za-z?!？！。…]', '', 'g')"


def alnum_sql(text: str) -> str:
    return rf"regexp_replace({text}, '[^\x{{4e00}}-\x{{9fa5}}0-9A-Za-z]', '', 'g')"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '', 'g')"


def _kept_sql(parts: str, min_len: int | None) -> str:
    if min_len is None:
        return parts
    return (
        f"list_transform(list_filter({parts}, lambda p: length(p) > {min_len}), "
        f"lambda p: {strip_sql('p')})"
    )


def sentences_sql(text: str, min_len: int | None = 10) -> str:
    clean = no_urls_sql(text)
    marked = rf"rtrim(regexp_replace({clean}, '([?!？！。…]+)', '\1' || chr(1), 'g'), chr(1))"
    parts = (
        f"case when length({clean}) = 0 then [] else "
        f"list_transform(string_split({marked}, chr(1)), lambda p: replace(p, ' ', '')) end"
    )
    return _kept_sql(parts, min_len)


def whole_text_sql(text: str, min_len: int | None = 10) -> str:
    clean = alnum_sql(text)
    return _kept_sql(f"case when length({clean}) = 0 then [] else [{clean}] end", min_len)


def words_sql(text: str) -> str:
    marks = fixed.ASCII_PUNCTUATION + fixed.WIDE_PUNCTUATION
    quoted = marks.replace("'", "''")
    spaced = f"translate({basic_sql(text)}, '{quoted}', '{' ' * len(marks)}')"
    spaced = rf"regexp_replace({spaced}, '([\x{{4e00}}-\x{{9fa5}}])', ' \1 ', 'g')"
    return f"list_filter(string_split({spaced}, ' '), lambda w: w <> '')"


# --- predictions: all components of a vector, folded into class scores


def _folded(size: int, place) -> Column:
    """One sum per class: the components whose place belongs to it."""
    vector = F.col("embedding").cast("array<double>")
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda k: F.aggregate(
            F.transform(vector, lambda x, j: F.when(place(j) == k, x).otherwise(0.0)),
            F.lit(0.0),
            lambda total, x: total + x,
        ),
    )


def predictions(t: Tables) -> DataFrame:
    rows = t.embeddings.select(
        F.col("vec_id").alias("id"),
        "label",
        _folded(10, lambda j: j % 10).alias("scores"),
        _folded(10, lambda j: F.floor(j / 7)).alias("teacher"),
        _folded(3, lambda j: j % 3).alias("emotion_scores"),
        F.transform(
            F.sequence(F.lit(0), F.lit(9)),
            lambda i: F.when(
                (i == F.col("label"))
                | ((F.col("vec_id").bitwiseAND(1) == 0) & (i == (F.col("label") + 1) % 10)),
                1,
            ).otherwise(0),
        ).alias("truth"),
    )
    return rows.withColumns(
        {"pred": argmax(F.col("scores")), "emotion": argmax(F.col("emotion_scores"))}
    )


def failing_predictions(t: Tables) -> DataFrame:
    """The same, with a failed prediction in every ninth row."""
    ok = F.col("id") % 9 != 4
    return predictions(t).withColumns(
        {c: F.when(ok, F.col(c)) for c in ("scores", "pred", "emotion")}
    )


def argmax_sql(vector: str) -> str:
    return f"cast(list_position({vector}, list_max({vector})) - 1 as integer)"


def _folded_sql(size: int, place: str) -> str:
    return (
        f"list_transform(range(0, {size}), lambda k: list_sum(list_transform(range(0, len(v)), "
        f"lambda j: case when {place} = k then v[j + 1] else 0.0 end)))"
    )


PREDICTIONS_SQL = f"""
vectors as (
  select vec_id as id, label, cast(embedding as double[]) as v from embeddings),
parts as (
  select id, label, {_folded_sql(10, 'j % 10')} as scores, {_folded_sql(10, 'j // 7')} as teacher,
         {_folded_sql(3, 'j % 3')} as emotion_scores,
         list_transform(range(0, 10), lambda i:
           case when i = label or ((id & 1) = 0 and i = (label + 1) % 10) then 1 else 0 end)
           as truth
  from vectors),
predictions as (
  select *, {argmax_sql('scores')} as pred, {argmax_sql('emotion_scores')} as emotion
  from parts)"""

FAILING_SQL = f"""{PREDICTIONS_SQL.replace('predictions as', 'whole as')},
predictions as (
  select id, label, case when id % 9 <> 4 then pred end as pred,
         case when id % 9 <> 4 then emotion end as emotion
  from whole)"""


def softmax_sql(vector: str) -> str:
    return (
        f"list_transform({vector}, lambda x: exp(x - list_max({vector})) / "
        f"list_sum(list_transform({vector}, lambda z: exp(z - list_max({vector})))))"
    )


def sigmoid_sql(vector: str) -> str:
    return f"list_transform({vector}, lambda x: 1.0 / (1.0 + exp(-x)))"


def vector_text(vector: Column, digits: int = 6) -> Column:
    """A vector as text with fixed digits, to compare it as a value."""
    scale = 10**digits
    return F.array_join(
        F.transform(vector, lambda x: F.round(x * scale).cast("long").cast("string")), " "
    )


def vector_text_sql(vector: str, digits: int = 6) -> str:
    scale = 10**digits
    return (
        f"list_aggregate(list_transform({vector}, lambda x: "
        f"cast(cast(round(x * {scale}) as bigint) as varchar)), 'string_agg', ' ')"
    )


# --- training rows


def training_rows(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id").select(
        "doc_id", "text", F.col("quality").alias("label"), "quality", "toxic"
    )


TRAINING_SQL = """
training_rows as (
  select d.doc_id, d.text, l.quality as label, l.quality, l.toxic
  from documents d join labels l on d.doc_id = l.doc_id)"""


# --- a keyword sheet out of the benchmark texts: one row per item, its words dealt over the cells


def keyword_sheet(t: Tables) -> DataFrame:
    """Every tenth word of a text, from the first, the second, ... on, makes a cell."""
    word = F.split("text", r"\s+")
    size = len(fixed.SHEET_KEYWORD_COLUMNS)

    def cell(place: int) -> Column:
        return F.array_join(F.filter(word, lambda w, i: i % size == place), "+")

    cells = [cell(place).alias(name) for place, name in enumerate(fixed.SHEET_KEYWORD_COLUMNS)]
    return t.benchmark.select(
        F.col("item_id").cast("int").alias("row_order"),
        F.lower(F.get(word, F.lit(0))).alias(fixed.SHEET_NAME_COLUMN),
        *cells,
    )


SHEET_SQL = r"""
benchmark_words as (
  select cast(item_id as integer) as row_order, string_split_regex(text, '\s+') as w from benchmark),
sheet as (
  select row_order, lower(coalesce(w[1], '')) as name,
         list_filter(list_transform(range(0, 10), lambda c: coalesce(list_aggregate(
           list_transform(list_filter(range(0, len(w)), lambda i: i % 10 = c), lambda i: w[i + 1]),
           'string_agg', '+'), '')), lambda k: k <> '') as cells
  from benchmark_words),
rules as (
  select name, min(row_order) as rule_order, max_by(cells, row_order) as cells
  from sheet where len(cells) > 0 group by name),
clauses as (
  select rule_order, name, unnest(cells) as cell from rules)"""


# --- a small fixed rule list, as a caller would give it

FIXED_SHEET = [
    (0, "comfort", ["and+the", "", "ein+der"]),
    (1, "power", ["that", "les"]),
    (2, "space", ["zzzq"]),
    (3, "empty", []),
    (4, "comfort", ["with+the", "que"]),
    (5, "dup", ["the+the"]),
]


def fixed_sheet(t: Tables) -> DataFrame:
    columns = ["row_order", fixed.SHEET_NAME_COLUMN, *fixed.SHEET_KEYWORD_COLUMNS]
    rows = [
        (order, name, *cells, *[""] * (10 - len(cells))) for order, name, cells in FIXED_SHEET
    ]
    types = ", ".join(["row_order int", *[f"{c} string" for c in columns[1:]]])
    return t.spark.createDataFrame(rows, types)


FIXED_RULES_SQL = """
clauses(rule_order, name, cell) as (
  values (0, 'comfort', 'with+the'), (0, 'comfort', 'que'),
         (1, 'power', 'that'), (1, 'power', 'les'),
         (2, 'space', 'zzzq'), (5, 'dup', 'the+the'))"""


def hits_sql(rows: str, key: str) -> str:
    """CTE `hits`: matched rule names per row of a relation (key, text)."""
    return f"""
hits as (
  select {key}, string_agg(name, ', ' order by rule_order) as hits
  from (
    select distinct r.{key}, c.rule_order, c.name
    from {rows} r join clauses c
      on len(list_filter(string_split(c.cell, '+'), lambda w: not contains(r.text, w))) = 0)
  group by {key})"""
