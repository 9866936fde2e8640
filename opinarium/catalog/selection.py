"""Projection, filters, joins, aggregates, sampling, limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.catalog import views as v
from opinarium.catalog.registry import Tables, query
from opinarium.functions.text import clean_basic, split_sentences, words
from opinarium.operators import dedup, evaluate, frames, joins, rules, sampling
from opinarium.operators.scoring import decode_label, label_table
from opinarium.plans import daily
from opinarium.plans.modelling import rejected
from opinarium.sources.warehouse import day_before


# --- projection and filters


@query(
    """select cast(doc_id as varchar) as news_uuid, lang as language, n_chars,
              '2024-01-01' as datatime from documents"""
)
def prj_columns(t: Tables) -> DataFrame:
    return (
        t.documents.select("doc_id", "lang", "source", "n_chars")
        .withColumnRenamed("lang", "language")
        .drop("source")
        .withColumn("datatime", F.lit(v.DAY))
        .withColumn("news_uuid", F.col("doc_id").cast("string"))
        .drop("doc_id")
    )


@query(
    """select d.doc_id, coalesce(cast(l.quality as varchar), '') as quality,
              coalesce(cast(l.toxic as varchar), '') as toxic
       from documents d left join labels l on d.doc_id = l.doc_id"""
)
def prj_fill_null(t: Tables) -> DataFrame:
    flags = t.labels.select(
        "doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string")
    )
    return t.documents.select("doc_id").join(flags, "doc_id", "left").fillna("")


@query(
    """select strftime(o_orderdate, '%Y-%m-%d') as day,
              strftime(o_orderdate - interval 1 day, '%Y-%m-%d') as data_day,
              count(*) as row_count
       from orders group by 1, 2"""
)
def prj_day_before(t: Tables) -> DataFrame:
    days = t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return (
        days.groupBy("day")
        .agg(F.count("*").alias("row_count"))
        .withColumn("data_day", day_before(F.col("day")))
    )


@query("select doc_id, lang from documents where lang in ('en', 'fr', 'de')")
def flt_labels(t: Tables) -> DataFrame:
    return t.documents.where(F.col("lang").isin(["en", "fr", "de"])).select("doc_id", "lang")


@query(
    f"""with {v.ARTICLES_SQL} select news_uuid, class2_label, class3_label from algo_classified
    where class2_label = 1 or class3_label = 1 or class4_label = 1 or class5_label = 1"""
)
def flt_any_flag(t: Tables) -> DataFrame:
    flagged = v.algo_classified(t).where(frames.any_flag(daily.CLASS_FLAGS))
    return flagged.select("news_uuid", "class2_label", "class3_label")


@query(
    f"""with s as (
      select doc_id, {v.sentences_sql("replace(text, '.', '!')")} as s from documents),
    rows_ as (select doc_id, unnest(s) as text from s where len(s) > 0)
    select doc_id, text from rows_ where length(text) > 5"""
)
def flt_sentence_length(t: Tables) -> DataFrame:
    marked = F.replace("text", F.lit("."), F.lit("!"))
    rows = frames.items(t.documents, ["doc_id"], split_sentences(marked), "text")
    return rows.where(F.length("text") > 5)


@query(
    f"""with w as (select item_id, unnest({v.words_sql('text')}) as word from benchmark)
    select item_id, word from w where length(word) >= 2"""
)
def flt_word_length(t: Tables) -> DataFrame:
    rows = t.benchmark.select("item_id", words(F.col("text")).alias("word"))
    return frames.flatten(rows, ["word"]).where(F.length("word") >= 2)


# nine names for ten classes: the last class has none, so its rows are failed predictions
NINE_NAMES = [f"class {i}" for i in range(9)]


@query(
    f"""with {v.PREDICTIONS_SQL}
    select count(*) as total_rows, count(*) filter (where pred = 9) as failed_rows,
           count(*) filter (where pred < 9) as kept_rows
    from predictions"""
)
def flt_failure_counts(t: Tables) -> DataFrame:
    rows = v.predictions(t).select(decode_label(F.col("scores"), NINE_NAMES).alias("property"))
    return frames.failure_counts(rows, ["property"])


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, 'class ' || pred as property from predictions where pred < 9"""
)
def flt_failures(t: Tables) -> DataFrame:
    rows = v.predictions(t).select("id", decode_label(F.col("scores"), NINE_NAMES).alias("property"))
    return frames.drop_failures(rows, ["property"])


@query(
    f"""with {v.FIXED_RULES_SQL},
    texts as (select doc_id, replace(text, '.', '!') as text from documents),
    {v.hits_sql('texts', 'doc_id')}
    select doc_id, hits from hits"""
)
def flt_rule_hits(t: Tables) -> DataFrame:
    """Only rows with at least one rule hit."""
    texts = t.documents.select("doc_id", F.replace("text", F.lit("."), F.lit("!")).alias("text"))
    listed = rules.compile_rules(v.fixed_sheet(t))
    tagged = rules.match_rules(texts, listed, keep_all=False, way=rules.CONDITIONS)
    return tagged.select("doc_id", F.array_join("hits", ", ").alias("hits"))


@query(
    f"""with {v.SHEET_SQL}
    select name, rule_order, list_aggregate(cells, 'string_agg', ' | ') as clauses from rules"""
)
def flt_empty_rules(t: Tables) -> DataFrame:
    """Rules compiled from a sheet; rows without keywords make none."""
    return rules.compile_rules(v.keyword_sheet(t)).select(
        "name",
        "rule_order",
        F.array_join(F.transform("clauses", lambda c: F.array_join(c, "+")), " | ").alias("clauses"),
    )


# --- joins


@query(f"with {v.ARTICLES_SQL} select news_uuid, md5(news_content) as content_md5 from selected")
def join_three_way(t: Tables) -> DataFrame:
    """Filter rows that occur twice give two copies of the article."""
    rows = daily.articles_of_day(
        v.news_info(t), v.algo_correlation(t), v.algo_classified(t), v.DAY, v.LABELS
    )
    return rows.select("news_uuid", F.md5("news_content").alias("content_md5"))


@query(
    f"""with {v.ARTICLES_SQL} select news_uuid, md5(news_content) as content_md5 from news_info
    where news_uuid in (select news_uuid from relevant)
      and news_uuid in (select news_uuid from flagged)"""
)
def join_three_way_semi(t: Tables) -> DataFrame:
    rows = daily.articles_of_day(
        v.news_info(t), v.algo_correlation(t), v.algo_classified(t), v.DAY, v.LABELS, semi=True
    )
    return rows.select("news_uuid", F.md5("news_content").alias("content_md5"))


@query(
    f"""with s as (select doc_id, {v.sentences_sql('text')} as s from documents)
    select doc_id, md5(unnest(case when len(s) = 0 then [null] else s end)) as text_md5 from s"""
)
def join_exploded(t: Tables) -> DataFrame:
    """List items next to their row; a row without items stays, with NULL."""
    rows = t.documents.select("doc_id", split_sentences(F.col("text")).alias("text"))
    return frames.flatten(rows, ["text"]).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    f"""with {v.SHEET_SQL}, {v.hits_sql('documents', 'doc_id')}
    select d.doc_id, coalesce(h.hits, '') as hits
    from documents d left join hits h on d.doc_id = h.doc_id"""
)
def join_rule_terms(t: Tables) -> DataFrame:
    """Whole documents and the terms of the sheet, joined on grams; ids name the texts."""
    listed = rules.compile_rules(v.keyword_sheet(t))
    tagged = rules.match_rules(t.documents.select("doc_id", "text"), listed, key="doc_id")
    return tagged.select("doc_id", "hits")


@query(
    f"""with {v.PREDICTIONS_SQL}
    select e.vec_id, e.label, p.pred, p.emotion
    from embeddings e join predictions p on e.vec_id = p.id"""
)
def join_predictions(t: Tables) -> DataFrame:
    truth = t.embeddings.select("vec_id", "label")
    predicted = v.predictions(t).select(F.col("id").alias("vec_id"), "pred", "emotion")
    return joins.attach_predictions(truth, predicted, "vec_id")


# --- aggregates


STAGES_SQL = f"""
stage_lists as (
  select news_uuid, {v.sentences_sql('news_content')} as s from selected),
stage_dedup as (
  select s, min(news_uuid) as news_uuid from stage_lists where len(s) > 0 group by s)"""


@query(
    f"""with {v.ARTICLES_SQL}, {STAGES_SQL}
    select news_uuid, len(s) as sentences, md5(list_aggregate(s, 'string_agg', '|')) as list_md5
    from stage_dedup"""
)
def agg_dedup_articles(t: Tables) -> DataFrame:
    articles = daily.articles_of_day(
        v.news_info(t), v.algo_correlation(t), v.algo_classified(t), v.DAY, v.LABELS, semi=True
    )
    return daily.article_lists(articles).select(
        "news_uuid",
        F.col("sentences").cast("long").alias("sentences"),
        F.md5(F.array_join("text", "|")).alias("list_md5"),
    )


@query(
    f"""with lists as (
      select doc_id, {v.sentences_sql("replace(text, '.', '!')")} as s from documents),
    numbered as (
      select doc_id, unnest(s) as text, cast(unnest(range(0, len(s))) as integer) as position from lists)
    select text, doc_id, position from (
      select *, row_number() over (partition by text order by doc_id, position) as n from numbered)
    where n = 1"""
)
def agg_dedup_sentences(t: Tables) -> DataFrame:
    marked = F.replace("text", F.lit("."), F.lit("!"))
    rows = frames.flatten(
        t.documents.select("doc_id", split_sentences(marked).alias("text")), ["text"], "position"
    ).where(F.col("text").isNotNull())
    return dedup.keep_first(rows, ["text"], ["doc_id", "position"])


@query(
    f"""with {v.PREDICTIONS_SQL}
    select pred, emotion, count(*) as row_count from predictions group by pred, emotion"""
)
def agg_strata(t: Tables) -> DataFrame:
    return sampling.strata(v.predictions(t), ["pred", "emotion"])


CAP_SQL = "(select 300 // count(*) from (select distinct pred, emotion from predictions))"


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, pred, emotion from (
      select *, row_number() over (partition by pred, emotion order by id desc) as n
      from predictions)
    where n <= {CAP_SQL}"""
)
def agg_capped_sample_ordered(t: Tables) -> DataFrame:
    """The capped sample with a plain column as draw order."""
    rows = v.predictions(t).select("id", "pred", "emotion")
    return sampling.capped_sample(
        rows, ["pred", "emotion"], ["id"], total=300, order=[F.col("id").desc()]
    )


@query(
    f"""with {v.PREDICTIONS_SQL}
    select pred, emotion, least(count(*), max({CAP_SQL})) as row_count
    from predictions group by pred, emotion"""
)
def agg_capped_sample(t: Tables) -> DataFrame:
    """Rows per stratum of the seeded draw."""
    rows = v.predictions(t).select("id", "pred", "emotion")
    return sampling.strata(
        sampling.capped_sample(rows, ["pred", "emotion"], ["id"], total=300), ["pred", "emotion"]
    )


WORD_WEIGHTS_SQL = f"""
occurrences as (
  select doc_id, unnest({v.words_sql('text')}) as word from documents),
weights as (
  select word, doc_id, cast(count(*) as double) as weight from occurrences group by word, doc_id)"""


def _word_weights(t: Tables) -> DataFrame:
    """Occurrences of each word in each text stand for its weight there."""
    rows = frames.items(t.documents, ["doc_id"], words(F.col("text")), "word")
    return rows.groupBy("word", "doc_id").agg(F.count("*").cast("double").alias("weight"))


@query(
    f"""with {WORD_WEIGHTS_SQL}
    select word, doc_id, weight from (
      select *, row_number() over (partition by word order by weight desc, doc_id desc) as n
      from weights)
    where n = 1"""
)
def agg_best_word(t: Tables) -> DataFrame:
    return dedup.best_words(_word_weights(t), "word", "weight")


@query("select count(distinct label) as classes from embeddings")
def agg_class_count(t: Tables) -> DataFrame:
    return evaluate.class_count(t.embeddings)


@query(
    """select cast(max(len([quality, toxic])) as integer) as classes,
              max(len([quality, toxic])) = min(len([quality, toxic])) as same_width
       from labels"""
)
def agg_label_width(t: Tables) -> DataFrame:
    from opinarium.functions.labels import parse_multi_hot

    text = F.concat(F.lit("["), F.col("quality"), F.lit(", "), F.col("toxic"), F.lit("]"))
    return evaluate.label_width(t.labels.select(parse_multi_hot(text).alias("y")), "y")


# --- ranking, sort, limit, union


@query(
    """select source, doc_id, n_chars from (
      select *, row_number() over (partition by source order by n_chars desc, doc_id) as n
      from documents)
    where n = 1"""
)
def win_first_of_group(t: Tables) -> DataFrame:
    """Keep-first by rank: the longest document of each source."""
    rows = t.documents.select("source", "doc_id", "n_chars")
    return dedup.top_rows(rows, ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 1)


@query(f"with {WORD_WEIGHTS_SQL} select word, weight, doc_id from weights order by word desc, weight desc")
def srt_two_columns(t: Tables) -> DataFrame:
    return _word_weights(t).select("word", "weight", "doc_id").orderBy(
        F.col("word").desc(), F.col("weight").desc()
    )


@query("select doc_id, lang, n_chars from documents order by doc_id limit 100")
def lim_first_rows(t: Tables) -> DataFrame:
    return frames.first_rows(t.documents.select("doc_id", "lang", "n_chars"), 100, ["doc_id"])


@query(
    f"""with {WORD_WEIGHTS_SQL}
    select doc_id, word, weight from (
      select *, row_number() over (partition by doc_id order by abs(weight) desc, word) as n
      from weights)
    where n <= 6"""
)
def lim_top_words(t: Tables) -> DataFrame:
    from opinarium.operators.explain import top_words

    return top_words(_word_weights(t).select("doc_id", "word", "weight"), "doc_id")


@query(
    """select doc_id as id, text from documents
       union all select item_id, text from benchmark
       union all select page_id, html from pages"""
)
def set_concat(t: Tables) -> DataFrame:
    parts = [
        t.documents.select(F.col("doc_id").alias("id"), "text"),
        t.benchmark.select(F.col("item_id").alias("id"), "text"),
        t.pages.select(F.col("page_id").alias("id"), F.col("html").alias("text")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """select d.doc_id, n.label_id from documents d join (
         select lang, cast(row_number() over (order by lang) - 1 as integer) as label_id
         from (select distinct lang from documents)) n on d.lang = n.lang"""
)
def lbl_name_to_id(t: Tables) -> DataFrame:
    from opinarium.operators.scoring import label_ids

    names = label_table(t.spark, ["de", "en", "es", "fr"])
    rows = t.documents.select("doc_id", F.col("lang").alias("property"))
    return label_ids(rows, names, "property").select("doc_id", "label_id")


@query(
    f"""with {v.TRAINING_SQL},
    joined as (
      select d.doc_id, l.doc_id is null as missing, d.text from documents d
      left join labels l on d.doc_id = l.doc_id)
    select doc_id, case when missing then null else md5({v.basic_sql('text')}) end as text_md5
    from joined"""
)
def str_clean_null(t: Tables) -> DataFrame:
    """A missing text stays missing."""
    rated = v.training_rows(t).select("doc_id", "text")
    rows = t.documents.select("doc_id").join(rated, "doc_id", "left")
    return rows.select("doc_id", F.md5(clean_basic(F.col("text"))).alias("text_md5"))


@query(
    """select d.doc_id from documents d left join labels l on d.doc_id = l.doc_id
       where l.doc_id is null"""
)
def flt_missing_text(t: Tables) -> DataFrame:
    """Rows that training rejects: those whose text is missing."""
    rated = v.training_rows(t).select("doc_id", "text")
    rows = t.documents.select("doc_id").join(rated, "doc_id", "left")
    return rejected(rows).select("doc_id")
