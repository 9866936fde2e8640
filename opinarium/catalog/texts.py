"""Text, array, rule and label functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.catalog import views as v
from opinarium.catalog.registry import Tables, query
from opinarium.functions import labels as lb
from opinarium.functions import text as tx
from opinarium.operators import frames, rules
from opinarium.operators.scoring import decode_label

# --- cleaning


@query(
    f"""with texts as (select page_id, 'see ' || url || ' and ' || html as text from pages)
    select page_id, {v.no_urls_sql('text')} as text from texts"""
)
def str_remove_urls(t: Tables) -> DataFrame:
    text = F.concat(F.lit("see "), F.col("url"), F.lit(" and "), F.col("html"))
    return t.pages.select("page_id", tx.remove_urls(text).alias("text"))


@query(
    f"""select 'document' as kind, doc_id as id, {v.basic_sql('text')} as text from documents
    union all select 'page', page_id, {v.basic_sql('html')} from pages"""
)
def str_clean_basic(t: Tables) -> DataFrame:
    documents = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), tx.clean_basic(F.col("text")).alias("text")
    )
    pages = t.pages.select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), tx.clean_basic(F.col("html")).alias("text")
    )
    return documents.unionByName(pages)


@query(
    f"""with texts as (
      select page_id, 'see ' || url || '  and ' || html as text from pages),
    clean as (select page_id, {v.basic_sql('text')} as text from texts)
    select page_id, {v.no_urls_sql('text')} as text from clean"""
)
def str_clean_train(t: Tables) -> DataFrame:
    text = F.concat(F.lit("see "), F.col("url"), F.lit("  and "), F.col("html"))
    return t.pages.select("page_id", tx.clean_train(text).alias("text"))


@query(f"select doc_id, {v.strict_sql('text')} as text from documents")
def str_clean_strict(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.clean_strict(F.col("text")).alias("text"))


@query(f"select doc_id, {v.alnum_sql('text')} as text from documents")
def str_clean_alnum(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", tx.clean_alnum(F.col("text")).alias("text"))


# --- sentences


def _marked(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.replace("text", F.lit("."), F.lit("!")).alias("text"))


def _split_sql(min_len: int | None) -> str:
    sentences = v.sentences_sql("replace(text, '.', '!')", min_len)
    return f"""with s as (select doc_id, {sentences} as s from documents)
    select doc_id, unnest(s) as sentence, cast(unnest(range(0, len(s))) as integer) as position
    from s"""


@query(_split_sql(10))
def sent_split(t: Tables) -> DataFrame:
    sentences = tx.split_sentences(F.col("text"))
    return frames.items(_marked(t), ["doc_id"], sentences, "sentence", "position")


@query(_split_sql(None))
def sent_split_no_minimum(t: Tables) -> DataFrame:
    sentences = tx.split_sentences(F.col("text"), None)
    return frames.items(_marked(t), ["doc_id"], sentences, "sentence", "position")


@query(
    f"""with s as (select doc_id, {v.whole_text_sql('text')} as s from documents)
    select doc_id, unnest(s) as sentence from s"""
)
def sent_whole_text(t: Tables) -> DataFrame:
    return frames.items(
        t.documents, ["doc_id"], tx.whole_text_sentence(F.col("text")), "sentence"
    )


# --- arrays


@query(
    """with lists as (select doc_id, string_split(text, chr(10)) as lines from documents),
    lines as (select doc_id, unnest(lines) as line from lists)
    select l.doc_id, md5(l.line) as line_md5, unnest([d.lang, d.source]) as tag
    from lines l join documents d on l.doc_id = d.doc_id"""
)
def arr_flatten(t: Tables) -> DataFrame:
    """Two list columns: every combination per row."""
    lists = t.documents.select(
        "doc_id", F.split("text", "\n", -1).alias("line"), F.array("lang", "source").alias("tag")
    )
    return frames.flatten(lists, ["line", "tag"]).select(
        "doc_id", F.md5("line").alias("line_md5"), "tag"
    )


@query(
    f"""select item_id, list_aggregate({v.words_sql('text')}, 'string_agg', ', ') as words
    from benchmark"""
)
def arr_join(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", tx.join_list(tx.words(F.col("text"))).alias("words"))


@query(
    f"""with w as (select item_id, {v.words_sql('text')} as w from benchmark),
    pairs as (select item_id, unnest(w) as word, unnest(list_transform(w, lambda x: length(x))) as weight from w)
    select item_id, word, weight from pairs"""
)
def arr_items(t: Tables) -> DataFrame:
    """Fields of the pairs in a list."""
    pairs = F.transform(
        tx.words(F.col("text")),
        lambda w: F.struct(w.alias("word"), F.length(w).cast("long").alias("weight")),
    )
    rows = frames.flatten(t.benchmark.select("item_id", pairs.alias("p")), ["p"])
    return rows.select("item_id", "p.word", "p.weight")


# --- rules


@query(
    f"""with {v.SHEET_SQL}
    select c.rule_order, c.name, count(*) as clauses,
           cast(sum(len(list_distinct(string_split(c.cell, '+')))) as bigint) as terms
    from clauses c group by c.rule_order, c.name"""
)
def rule_compile(t: Tables) -> DataFrame:
    listed = rules.compile_rules(v.keyword_sheet(t))
    terms = F.aggregate(
        F.transform("clauses", lambda c: F.size(F.array_distinct(c)).cast("long")),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    return listed.select(
        "rule_order", "name", F.size("clauses").cast("long").alias("clauses"), terms.alias("terms")
    )


@query(
    f"""with {v.FIXED_RULES_SQL},
    texts as (select doc_id, replace(text, '.', '!') as text from documents),
    {v.hits_sql('texts', 'doc_id')}
    select t.doc_id, coalesce(h.hits, '') as hits
    from texts t left join hits h on t.doc_id = h.doc_id"""
)
def rule_match_few(t: Tables) -> DataFrame:
    """A short rule list: conditions in the query. Rows without a hit stay."""
    listed = rules.compile_rules(v.fixed_sheet(t))
    return rules.match_rules(_marked(t), listed, way=rules.CONDITIONS).select("doc_id", "hits")


@query(
    f"""with {v.SHEET_SQL}, {v.hits_sql('documents', 'doc_id')}
    select d.doc_id, coalesce(h.hits, '') as hits
    from documents d left join hits h on d.doc_id = h.doc_id"""
)
def rule_match_many(t: Tables) -> DataFrame:
    """Rules out of a sheet that grows with the benchmark table."""
    listed = rules.compile_rules(v.keyword_sheet(t))
    return rules.match_rules(t.documents.select("doc_id", "text"), listed).select("doc_id", "hits")


# --- labels


@query(f"with {v.PREDICTIONS_SQL} select id, pred, emotion from predictions")
def lbl_argmax(t: Tables) -> DataFrame:
    return v.predictions(t).select("id", "pred", "emotion")


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, ['负面', '中性', '正面'][emotion + 1] as emotion from predictions"""
)
def lbl_decode(t: Tables) -> DataFrame:
    from opinarium.functions.fixed_values import EMOTION_NAMES

    return v.predictions(t).select(
        "id", decode_label(F.col("emotion_scores"), EMOTION_NAMES).alias("emotion")
    )


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, ['负面', '中性', '正面'][emotion + 1] as emotion from predictions"""
)
def lbl_decode_table(t: Tables) -> DataFrame:
    """The same with the label map as a table."""
    from opinarium.functions.fixed_values import EMOTION_NAMES
    from opinarium.operators.scoring import decode_by_table, label_table

    rows = v.predictions(t).select("id", "emotion_scores")
    named = decode_by_table(rows, label_table(t.spark, EMOTION_NAMES), "emotion_scores", "emotion")
    return named.select("id", "emotion")


@query(
    """select doc_id, cast(quality as double) as first, cast(toxic as double) as second,
              cast(2 as integer) as width
       from labels"""
)
def lbl_multi_hot(t: Tables) -> DataFrame:
    text = F.concat(F.lit("["), F.col("quality"), F.lit(","), F.col("toxic"), F.lit(" ]"))
    return t.labels.select("doc_id", lb.parse_multi_hot(text).alias("y")).select(
        "doc_id", F.col("y")[0].alias("first"), F.col("y")[1].alias("second"), F.size("y").alias("width")
    )


@query(
    """select vec_id, list_aggregate(list_transform(range(0, 10), lambda i:
         case when i = label then '1' else '0' end), 'string_agg', ' ') as one_hot
       from embeddings"""
)
def lbl_one_hot(t: Tables) -> DataFrame:
    vector = lb.one_hot(F.col("label"), 10).cast("array<string>")
    return t.embeddings.select("vec_id", F.array_join(vector, " ").alias("one_hot"))


@query(
    f"""with {v.PREDICTIONS_SQL},
    p as (select id, pred, {v.softmax_sql('scores')} as p from predictions)
    select id, {v.vector_text_sql('p')} as probabilities, pred as best,
           round(p[pred + 1], 6) as best_probability
    from p"""
)
def lbl_softmax(t: Tables) -> DataFrame:
    rows = v.predictions(t).withColumn("m", lb.class_probabilities(F.col("scores")))
    probabilities = F.map_values("m")
    return rows.select(
        "id",
        v.vector_text(probabilities).alias("probabilities"),
        lb.argmax(probabilities).alias("best"),
        F.round(F.element_at("m", lb.argmax(F.col("scores"))), 6).alias("best_probability"),
    )


@query(
    f"""with {v.PREDICTIONS_SQL},
    p as (select id, {v.sigmoid_sql('scores')} as p from predictions)
    select id, {v.vector_text_sql('p')} as probabilities,
           list_aggregate(list_transform(p, lambda x: case when x >= 0.5 then '1' else '0' end),
                          'string_agg', ' ') as labels
    from p"""
)
def lbl_sigmoid_threshold(t: Tables) -> DataFrame:
    p = lb.sigmoid(F.col("scores"))
    return v.predictions(t).select(
        "id",
        v.vector_text(p).alias("probabilities"),
        F.array_join(lb.threshold(p).cast("array<string>"), " ").alias("labels"),
    )
