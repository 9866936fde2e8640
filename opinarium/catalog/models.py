"""Encoding, features, scoring, training and explanation."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.catalog import views as v
from opinarium.catalog.registry import Tables, query
from opinarium.functions import fixed_values as fixed
from opinarium.functions.labels import argmax, parse_multi_hot, softmax
from opinarium.functions.losses import cross_entropy
from opinarium.functions.text import clean_basic, words
from opinarium.operators import encode as enc
from opinarium.operators import boosting, evaluate, explain, features, frames, scoring, sparse, training
from opinarium.operators.rules import CONDITIONS, compile_rules
from opinarium.plans import daily
from opinarium.runtime import materialize, new_folder

# --- vocabulary and encoding

VOCABULARY_SQL = f"""
tokens as (select unnest({v.words_sql('text')}) as token from documents),
counted as (select token, count(*) as occurrences from tokens group by token),
vocabulary as (
  select token, occurrences,
         row_number() over (order by occurrences desc, token) - 1 + 4 as id
  from counted)"""


def _vocabulary(t: Tables) -> DataFrame:
    return enc.build_vocabulary(t.documents, words(F.col("text")))


@query(f"with {VOCABULARY_SQL} select token, occurrences, id from vocabulary")
def enc_vocabulary(t: Tables) -> DataFrame:
    return _vocabulary(t)


def _ids_sql(rows: str, key: str) -> str:
    """CTE `ids`: the token ids of a relation (key, w), in order."""
    return f"""
ids as (
  select r.{key}, list(coalesce(o.id, 1) order by r.pos) as ids
  from (select {key}, unnest(w) as token, unnest(range(0, len(w))) as pos from {rows}) r
  left join vocabulary o on r.token = o.token group by r.{key})"""


def _encoded_sql(max_len: int, tokens: str) -> str:
    return f"""cut as (select doc_id, ({tokens})[1:{max_len - 2}] as w from documents),
    {_ids_sql('cut', 'doc_id')},
    framed as (
      select c.doc_id, list_concat([2], coalesce(i.ids, []), [3]) as ids
      from cut c left join ids i on c.doc_id = i.doc_id)
    select doc_id,
           list_aggregate(list_concat(ids, list_transform(range(0, {max_len} - len(ids)), lambda x: 0)),
                          'string_agg', ' ') as input_ids,
           cast(len(ids) as bigint) as real_tokens, cast({max_len} as integer) as length
    from framed"""


def _shown(df: DataFrame) -> DataFrame:
    ones = F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b)
    return df.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        ones.cast("long").alias("real_tokens"),
        F.size("attention_mask").alias("length"),
    )


@query(f"with {VOCABULARY_SQL}, {_encoded_sql(128, v.words_sql('text'))}")
def enc_encode(t: Tables) -> DataFrame:
    encoded = enc.encode(t.documents, _vocabulary(t), words(F.col("text")), "doc_id", 128)
    return _shown(encoded)


BLANK_WORDS_SQL = f"list_filter(string_split({v.basic_sql('text')}, ' '), lambda w: w <> '')"


@query(f"with {VOCABULARY_SQL}, {_encoded_sql(32, BLANK_WORDS_SQL)}")
def enc_words(t: Tables) -> DataFrame:
    """Pre-split words as tokens; words with punctuation are unknown to the vocabulary."""
    split = F.array_remove(F.split(clean_basic(F.col("text")), " "), "")
    rows = t.documents.select("doc_id", split.alias("tokens"))
    return _shown(enc.encode(rows, _vocabulary(t), F.col("tokens"), "doc_id", 32))


PAIR_LEN = 64


@query(
    f"""with {VOCABULARY_SQL},
    pairs as (
      select q.conv_id * 1000 + q.turn as pair_id, {v.basic_sql('q.text')} as question,
             {v.basic_sql('a.text')} as answer
      from conversations q join conversations a
        on q.conv_id = a.conv_id and a.turn = q.turn + 1
      where q.role = 'user' and a.role = 'assistant'),
    split_ as (
      select pair_id, list_filter(string_split(question, ' '), lambda w: w <> '') as a,
             list_filter(string_split(answer, ' '), lambda w: w <> '') as b
      from pairs),
    sized as (
      select *, len(a) as na, len(b) as nb, {PAIR_LEN - 3} as room from split_),
    kept as (
      select *, case when na + nb <= room then na
                     when nb <= room // 2 then room - nb
                     when na <= (room + 1) // 2 then na
                     else (room + 1) // 2 end as ka
      from sized),
    cut as (
      select pair_id, a[1:ka] as a, b[1:case when na + nb <= room then nb else room - ka end] as b
      from kept),
    placed as (
      select pair_id, 0 as side, unnest(a) as token, unnest(range(0, len(a))) as pos,
             unnest(list_transform(range(0, len(a)), lambda i:
               coalesce(list_sum(list_transform(a[1:i], lambda w: length(w) + 1)), 0))) as start_
      from cut
      union all
      select pair_id, 1, unnest(b), unnest(range(0, len(b))),
             unnest(list_transform(range(0, len(b)), lambda i:
               coalesce(list_sum(list_transform(b[1:i], lambda w: length(w) + 1)), 0)))
      from cut)
    select p.pair_id, cast(p.side as integer) as segment, p.token,
           cast(coalesce(o.id, 1) as integer) as input_id, cast(p.start_ as integer) as start_at,
           cast(p.start_ + length(p.token) as integer) as end_at
    from placed p left join vocabulary o on p.token = o.token"""
)
def enc_pair(t: Tables) -> DataFrame:
    """A question and the answer behind it, encoded as one; shown per real token."""
    q = t.conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", clean_basic(F.col("text")).alias("question")
    )
    a = t.conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), clean_basic(F.col("text")).alias("answer")
    )
    pairs = q.join(a, ["conv_id", "turn"]).withColumn(
        "pair_id", F.col("conv_id") * 1000 + F.col("turn")
    )

    def side(name: str):
        return F.col(name), F.array_remove(F.split(name, " "), "")

    encoded = enc.encode_pair(
        pairs, _vocabulary(t), side("question"), side("answer"), "pair_id", PAIR_LEN
    )
    cells = F.arrays_zip("input_ids", "segment_ids", "attention_mask", "offsets")
    rows = encoded.select("pair_id", F.explode(cells).alias("c")).select("pair_id", "c.*")
    real = rows.where((F.col("attention_mask") == 1) & ~F.col("input_ids").isin(enc.START, enc.END))
    texts = pairs.select("pair_id", "question", "answer")
    text = F.when(F.col("segment_ids") == 0, F.col("question")).otherwise(F.col("answer"))
    start, end = F.col("offsets.start"), F.col("offsets.end")
    return real.join(texts, "pair_id").select(
        "pair_id",
        F.col("segment_ids").alias("segment"),
        F.substring(text, start + 1, end - start).alias("token"),
        F.col("input_ids").alias("input_id"),
        start.alias("start_at"),
        end.alias("end_at"),
    )


@query(
    f"""with w as (select doc_id, {v.words_sql('text')} as w from documents)
    select doc_id, cast(len(w) as integer) as word_count,
           md5(coalesce(list_aggregate(w, 'string_agg', ' '), '')) as words_md5
    from w"""
)
def enc_word_list(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", words(F.col("text")).alias("w"))
    return rows.select(
        "doc_id", F.size("w").alias("word_count"), F.md5(F.array_join("w", " ")).alias("words_md5")
    )


# --- features


def _counted(t: Tables, binary: bool) -> DataFrame:
    """Words learned from the rated documents, counted in all."""
    bags = t.documents.select("doc_id", features.word_bag(F.col("text")).alias("tokens"))
    rated = bags.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    known = features.vocabulary(rated, "tokens")
    cells = features.word_counts(bags, "doc_id", "tokens", known, binary)
    return cells.select("doc_id", "word", F.col("value").alias("n"))


def _counts_sql(value: str) -> str:
    return f"""with bags as (
      select doc_id, unnest({v.words_sql('lower(text)')}) as word from documents),
    listed as (select distinct word from bags where doc_id in (select doc_id from labels))
    select doc_id, word, cast({value} as double) as n
    from bags where word in (select word from listed) group by doc_id, word"""


@query(_counts_sql("count(*)"))
def fea_word_counts(t: Tables) -> DataFrame:
    return _counted(t, binary=False)


@query(_counts_sql("1"))
def fea_presence(t: Tables) -> DataFrame:
    return _counted(t, binary=True)


def _bags(t: Tables) -> DataFrame:
    """The rated documents and their words."""
    return v.training_rows(t).withColumn("tokens", features.word_bag(F.col("text"))).drop("text")


# Multinomial naive Bayes in closed form, one smoothing count per word; `raw` is the log joint
# probability of a document and a class. Two more features stand behind the words where
# `shares` says so, both 0.5 in every row.


def _bayes_sql(learned: str = "true", shares: bool = False) -> str:
    more, extra = ("c.docs", "2") if shares else ("0", "0")
    share = (
        "+ ln(0.5 * c.docs + 1) - ln(t.total + c.docs + w.width + 2)" if shares else ""
    )
    return f"""{v.TRAINING_SQL},
bags as (
  select doc_id, label, {learned} as learned, unnest({v.words_sql('lower(text)')}) as word
  from training_rows),
classes as (
  select label, count(*) as docs from training_rows where {learned} group by label),
totals as (select label, count(*) as total from bags where learned group by label),
width as (select count(distinct word) as width from bags where learned),
known as (select distinct word from bags where learned),
per_class as (select label, word, count(*) as n from bags where learned group by label, word),
counts as (
  select b.doc_id, b.word, count(*) as n from bags b join known k on b.word = k.word
  group by b.doc_id, b.word),
cells as (
  select n.doc_id, c.label as class,
         sum(n.n * (ln(coalesce(p.n, 0) + 1) - ln(t.total + {more} + w.width + {extra}))) as s
  from counts n cross join classes c cross join width w
  join totals t on t.label = c.label
  left join per_class p on p.label = c.label and p.word = n.word
  group by n.doc_id, c.label),
raw as (
  select r.doc_id, r.label, r.quality, c.label as class,
         ln(c.docs + 1) - ln((select sum(docs) from classes) + (select count(*) from classes))
         + coalesce(s.s, 0) {share} as raw
  from training_rows r cross join classes c cross join width w
  join totals t on t.label = c.label
  left join cells s on s.doc_id = r.doc_id and s.class = c.label),
judged as (
  select doc_id, any_value(label) as label,
         max(raw) filter (where class = 1) - max(raw) filter (where class = 0) as margin
  from raw group by doc_id)"""


def _bayes(t: Tables) -> DataFrame:
    """The rated documents under a naive Bayes model of themselves, over all words."""
    rows = materialize(_bags(t), "bags")
    raw = training.word_bayes(rows, "doc_id", "label", "tokens")
    counted = features.hashed_counts("tokens", "features", 1 << 18).transform(rows)
    scored = counted.select("doc_id", "label", "features").join(raw, "doc_id").select(
        "doc_id", "label", "features", "raw",
        array_to_vector(softmax(F.col("raw"))).alias("probability"),
        argmax(F.col("raw")).alias("prediction"),
    )
    return materialize(scored, "bayes")


@query(
    f"""with {_bayes_sql()},
    sized as (select doc_id, count(*) as words from bags group by doc_id)
    select r.doc_id, coalesce(z.words, 0)::double as words,
           round(1 / (1 + exp(-j.margin)), 6) as second, round(1 / (1 + exp(j.margin)), 6) as first
    from training_rows r left join sized z on z.doc_id = r.doc_id join judged j on j.doc_id = r.doc_id"""
)
def fea_append_probabilities(t: Tables) -> DataFrame:
    """Count vectors with a second model's probabilities behind them: both parts, by row."""
    rows = _bayes(t)
    wide = features.with_probabilities(
        rows.select("doc_id", "features"), rows, "doc_id", "features", "both"
    )
    both = wide.select("doc_id", features.entries(F.col("both")).alias("both"), features.width(F.col("both")).alias("size"))

    def total(start: Column, stop: Column) -> Column:
        held = F.filter("both", lambda c: (c["index"] >= start) & (c["index"] < stop))
        return F.aggregate(held, F.lit(0.0), lambda a, c: a + c["value"])

    size = F.col("size")
    return both.select(
        "doc_id",
        total(F.lit(0), size - 2).alias("words"),
        F.round(total(size - 2, size - 1), 6).alias("first"),
        F.round(total(size - 1, size), 6).alias("second"),
    )


@query(
    f"""with {v.PREDICTIONS_SQL}
    select id, case when pred <> label then 10.0::double else 1.0::double end as weight
    from predictions"""
)
def fea_error_weight(t: Tables) -> DataFrame:
    rows = v.predictions(t)
    return rows.select("id", features.error_weight(F.col("pred"), F.col("label")).alias("weight"))


# --- scoring

# weights of the linear scorers: a small repeating pattern, so that SQL can state it too
PROPERTY_WEIGHTS = [[((7 * k + 3 * j) % 11 - 5) / 10 for j in range(64)] for k in range(10)]
EMOTION_WEIGHTS = [[((5 * k + 2 * j) % 7 - 3) / 10 for j in range(64)] for k in range(3)]

SCORED_SQL = """
vectors as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
scored as (
  select vec_id, label,
    list_transform(range(0, 10), lambda k: list_sum(list_transform(range(0, 64), lambda j:
      v[j + 1] * ((7 * k + 3 * j) % 11 - 5) / 10.0))) as property,
    list_transform(range(0, 3), lambda k: list_sum(list_transform(range(0, 64), lambda j:
      v[j + 1] * ((5 * k + 2 * j) % 7 - 3) / 10.0))) as emotion
  from vectors)"""


@query(
    f"""with {SCORED_SQL}
    select vec_id, {v.vector_text_sql('property')} as scores, {v.argmax_sql('property')} as pred
    from scored"""
)
def sco_one_model(t: Tables) -> DataFrame:
    score = scoring.batch_scorer(scoring.linear_factory(PROPERTY_WEIGHTS), input_shape=[64])
    rows = t.embeddings.select("vec_id", score("embedding").alias("s"))
    return rows.select("vec_id", v.vector_text(F.col("s")).alias("scores"), argmax(F.col("s")).alias("pred"))


@query(f"with {SCORED_SQL} select vec_id, {v.argmax_sql('property')} as pred from scored")
def sco_portable_model(t: Tables) -> DataFrame:
    """The same linear scorer, saved as a table and loaded again; scores in the JVM."""
    path = new_folder(t.spark, "linear-model")
    scoring.save_linear(t.spark, PROPERTY_WEIGHTS, path)
    score = scoring.load_linear(t.spark, path)
    return t.embeddings.select("vec_id", argmax(score(F.col("embedding"))).alias("pred"))


TWO_HEADS_SQL = f"""with {SCORED_SQL}
    select vec_id, {v.argmax_sql('property')} as property, {v.argmax_sql('emotion')} as emotion,
           {v.vector_text_sql('emotion')} as emotion_scores
    from scored"""


@query(TWO_HEADS_SQL)
def sco_two_heads(t: Tables) -> DataFrame:
    model = scoring.two_heads(
        scoring.linear_factory(PROPERTY_WEIGHTS),
        scoring.linear_factory(EMOTION_WEIGHTS),
        ["property", "emotion"],
    )
    score = scoring.two_head_scorer(model, ["property", "emotion"], input_shape=[64])
    rows = t.embeddings.select("vec_id", score("embedding").alias("s"))
    return rows.select(
        "vec_id",
        argmax(F.col("s.property")).alias("property"),
        argmax(F.col("s.emotion")).alias("emotion"),
        v.vector_text(F.col("s.emotion")).alias("emotion_scores"),
    )


@query(TWO_HEADS_SQL)
def sco_two_models(t: Tables) -> DataFrame:
    first = scoring.batch_scorer(scoring.linear_factory(PROPERTY_WEIGHTS), input_shape=[64])
    second = scoring.batch_scorer(scoring.linear_factory(EMOTION_WEIGHTS), input_shape=[64])
    score = scoring.two_model_scorer(first, second, ["property", "emotion"])
    rows = t.embeddings.select("vec_id", score(F.col("embedding")).alias("s"))
    return rows.select(
        "vec_id",
        argmax(F.col("s.property")).alias("property"),
        argmax(F.col("s.emotion")).alias("emotion"),
        v.vector_text(F.col("s.emotion")).alias("emotion_scores"),
    )


def refusing(model: scoring.Factory) -> scoring.Factory:
    """A model that raises on any batch with a row whose first component leaves 4 when divided by 9."""

    def load():
        predict = model()

        def checked(vectors):
            if (vectors[:, 0] % 9 == 4).any():
                raise ValueError("a row that this model cannot score")
            return predict(vectors[:, 1:])

        return checked

    return load


def _unless_refused(expression: str) -> str:
    return f"case when vec_id % 9 <> 4 then {expression} end"


@query(
    f"""with {SCORED_SQL}
    select vec_id, {_unless_refused(v.argmax_sql('property'))} as one_model,
           {_unless_refused(v.argmax_sql('property'))} as property,
           {_unless_refused(v.argmax_sql('emotion'))} as emotion,
           {v.argmax_sql('property')} as first_model, {_unless_refused(v.argmax_sql('emotion'))} as second_model,
           (select count(*) from embeddings where vec_id % 9 = 4) as failed
    from scored"""
)
def sco_failed_rows(t: Tables) -> DataFrame:
    """One model, two heads and two models of which the second fails: each failing row fails alone."""
    first, second = (scoring.linear_factory(w) for w in (PROPERTY_WEIGHTS, EMOTION_WEIGHTS))
    heads = ["property", "emotion"]
    failing = refusing(scoring.two_heads(first, second, heads))
    lenient = scoring.batch_scorer(first, input_shape=[64])
    counted = t.spark.sparkContext.accumulator(0)
    one = scoring.batch_scorer(refusing(first), input_shape=[65], failures=counted)
    two = scoring.two_head_scorer(failing, heads, input_shape=[65])
    strict = scoring.batch_scorer(refusing(second), input_shape=[65])
    vector = F.col("embedding").cast("array<double>")
    marked = F.concat(F.array(F.col("vec_id").cast("double")), vector)
    rows = t.embeddings.select(
        "vec_id",
        one(marked).alias("one"),
        two(marked).alias("two"),
        F.struct(lenient(vector).alias("first"), strict(marked).alias("second")).alias("both"),
    )
    scored = materialize(rows, "scored")
    # a repeated task counts its rows again, so the number is checked against what was written
    failed = scored.where(F.col("one").isNull()).count()
    assert counted.value >= failed
    return scored.select(
        "vec_id",
        argmax(F.col("one")).alias("one_model"),
        argmax(F.col("two.property")).alias("property"),
        argmax(F.col("two.emotion")).alias("emotion"),
        argmax(F.col("both.first")).alias("first_model"),
        argmax(F.col("both.second")).alias("second_model"),
        F.lit(failed).cast("long").alias("failed"),
    )


# --- the daily job, with a scorer that any text can be checked against by hand

# All names of the label map and the catch-all class; the class behind them has no name and fails.
PROPERTY_LABELS = [*fixed.PROPERTY_NAMES, fixed.CATCH_ALL_PROPERTY]
PROPERTY_CLASSES = len(PROPERTY_LABELS) + 1
EMOTION_CUES = ["an", "e", "io"]


def cue_scorer(text: Column) -> Column:
    """Property: the class whose number is the length of the text, modulo the classes.

    Emotion: how often each cue occurs.
    """
    place = F.length(text) % PROPERTY_CLASSES
    property_scores = F.concat(
        F.array_repeat(F.lit(0.0), place),
        F.array(F.lit(1.0)),
        F.array_repeat(F.lit(0.0), PROPERTY_CLASSES - 1 - place),
    )
    emotion_scores = F.array(
        *[
            (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) / float(len(c))
            for c in EMOTION_CUES
        ]
    )
    return F.struct(property_scores.alias("property"), emotion_scores.alias("emotion"))


def _cue_sql(text: str, cues: list[str]) -> str:
    counts = ", ".join(
        f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in cues
    )
    return v.argmax_sql(f"[{counts}]")


def _names_sql(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _day(t: Tables) -> tuple:
    return (
        v.news_info(t),
        v.algo_correlation(t),
        v.algo_classified(t),
        v.DAY,
        v.LABELS,
        cue_scorer,
        PROPERTY_LABELS,
    )


def _rules(t: Tables) -> DataFrame:
    return compile_rules(v.fixed_sheet(t))


def _daily(t: Tables, variant: daily.Variant, rules: DataFrame | None = None) -> DataFrame:
    order = [F.col("news_uuid"), F.col("position")]
    return daily.daily_opinions(
        *_day(t), rules, variant, rule_way=CONDITIONS, draw_order=order
    )


def _daily_sql(sentences: str, rules: bool, required: str = "property is not null and emotion is not null") -> str:
    """Scored rows over a chain of CTEs that ends in `sentence_rows` (row_id, news_uuid, text)."""
    hits = v.hits_sql("sentence_rows", "row_id") if rules else "hits as (select null as row_id, '' as hits)"
    fixed_rules = f"{v.FIXED_RULES_SQL}," if rules else ""
    return f"""with {v.ARTICLES_SQL}, {fixed_rules} {sentences}, {hits},
    clean as (select *, {v.strict_sql('text')} as c from sentence_rows),
    scored as (
      select c.*, coalesce(h.hits, '') as hits, cast(length(c.c) % {PROPERTY_CLASSES} as integer) as p,
             {_cue_sql('c.c', EMOTION_CUES)} as e
      from clean c left join hits h on c.row_id = h.row_id),
    labelled as (
      select text, news_uuid, row_id, position, hits, {_names_sql(PROPERTY_LABELS)}[p + 1] as property,
             {_names_sql(fixed.EMOTION_NAMES)}[e + 1] as emotion, '{v.DAY}' as datatime
      from scored),
    opinions as (
      select * replace (coalesce(property, '') as property) from labelled where {required})"""


def _article_sentences_sql(min_len: int | None) -> str:
    return f"""
    lists as (select news_uuid, {v.sentences_sql('news_content', min_len)} as s from selected),
    kept as (select s, min(news_uuid) as news_uuid from lists where len(s) > 0 group by s),
    spread as (select news_uuid, unnest(s) as text, unnest(range(0, len(s))) as position from kept),
    long_rows as (select * from spread where length(text) > 5)"""


@query(
    _daily_sql(
        _article_sentences_sql(10)
        + ", sentence_rows as (select *, news_uuid || ':' || position as row_id from long_rows)",
        rules=True,
    )
    + " select text, news_uuid, property, emotion, hits, datatime from opinions"
)
def daily_full(t: Tables) -> DataFrame:
    """Articles of the day to scored, tagged sentences."""
    return _daily(t, daily.FULL, _rules(t))


@query(
    _daily_sql(
        _article_sentences_sql(10)
        + ", sentence_rows as (select *, news_uuid || ':' || position as row_id from long_rows)",
        rules=True,
    )
    + """ select 'query' as stage, count(*) as row_count from selected
    union all select 'articles', count(*) from kept
    union all select 'sentences', count(*) from long_rows
    union all select 'rules', count(*) from sentence_rows
    union all select 'failed', count(*) from labelled where property is null or emotion is null
    union all select 'final', count(*) from opinions"""
)
def agg_stage_counts(t: Tables) -> DataFrame:
    """The run summary of the daily job."""
    return daily.daily_with_counts(*_day(t), _rules(t), rule_way=CONDITIONS)[1]


def _distinct_rows_sql(min_len: int | None) -> str:
    return (
        _article_sentences_sql(min_len)
        + """, sentence_rows as (
      select text, news_uuid, position, news_uuid || ':' || position as row_id
      from (select *, row_number() over (partition by text order by news_uuid, position) as n
            from long_rows) where n = 1)"""
    )


def _capped_sql(total: int) -> str:
    """CTE `drawn`: the rows of each stratum that come first, up to the cap."""
    return f""",
    strata as (select distinct property, emotion from opinions),
    drawn as (
      select * from (
        select *, row_number() over (partition by property, emotion order by news_uuid, position) as n
        from opinions)
      where n <= (select {total} // count(*) from strata))"""


# Small enough that the cap binds at every size of the tables.
DRAWN = 1_000


@query(
    _daily_sql(_distinct_rows_sql(10), rules=False, required="emotion is not null")
    + _capped_sql(DRAWN)
    + " select text, news_uuid, property, emotion, datatime from drawn"
)
def daily_two_heads(t: Tables) -> DataFrame:
    """Distinct sentences with a capped sample, the first rows of each stratum."""
    return _daily(t, replace(daily.TWO_HEADS, total=DRAWN))


@query(
    _daily_sql(_distinct_rows_sql(None), rules=True, required="emotion is not null").replace(
        "opinions as (", "every as ("
    )
    + ", opinions as (select * from every where hits <> '')"
    + _capped_sql(DRAWN)
    + """ select text, news_uuid, property, emotion, unnest(string_split(hits, ', ')) as hits, datatime
    from drawn"""
)
def daily_hits_only(t: Tables) -> DataFrame:
    """Distinct sentences of any length with a rule hit, a capped sample, one row per hit."""
    return _daily(t, replace(daily.HITS_ONLY, total=DRAWN), _rules(t))


@query(
    _daily_sql(
        f"""lists as (select news_uuid, {v.whole_text_sql('news_content')} as s,
                      row_number() over () as copy from selected),
    sentence_rows as (
      select news_uuid, unnest(s) as text, 0 as position, copy as row_id from lists)""",
        rules=False,
    )
    + _capped_sql(DRAWN)
    + " select text, news_uuid, property, emotion, datatime from drawn"
)
def daily_whole_texts(t: Tables) -> DataFrame:
    """Each article one text, copies kept, a capped sample."""
    return _daily(t, replace(daily.WHOLE_TEXTS, total=DRAWN))


# --- training


PENALTY = 0.25

# At the optimum of a penalised linear model the slope by every weight is zero: the residuals of a word's rows
# and the penalty cancel out. A model that does not see the words has other slopes at them.


def _slopes_sql(*names: str) -> str:
    return f"""with {v.TRAINING_SQL},
    bags as (select doc_id, unnest({v.words_sql('lower(text)')}) as word from training_rows),
    every as (
      select word, count(distinct doc_id) as docs from bags group by word
      union all select '', count(*) from training_rows)
    select word, docs, {', '.join(f'0.0::double as {n}' for n in names)} from every"""


def _rated(t: Tables, classes: int) -> tuple[DataFrame, sparse.Packed]:
    """The rated documents with a two-class target per flag, and their words as cells, listed by row for so many classes."""
    no, yes = (F.array(F.lit(1.0 - c), F.lit(float(c))) for c in (0, 1))
    both = [F.when(F.col(c) == 1, yes).otherwise(no).alias(f"{c}_is") for c in ("quality", "toxic")]
    rows = materialize(_bags(t).select("doc_id", "tokens", "quality", "toxic", *both), "rated")
    cells = materialize(sparse.unit_cells(rows, "doc_id", "tokens"), "cells")
    return rows.drop("tokens"), sparse.packed(cells, "doc_id", classes)


def _slopes(rows: DataFrame, cells: sparse.Packed, residual: sparse.Residual, names: list[str]) -> tuple[DataFrame, sparse.Linear]:
    # the slopes of the whole loss are shown with two digits, so those of the mean must be the smaller the more rows there are
    tolerance = min(5e-7, 0.004 / max(rows.count(), 1))
    model = sparse.fit(rows, cells, "doc_id", residual, len(names), PENALTY, tolerance=tolerance)
    slopes = sparse.slopes_at(rows, cells, "doc_id", residual, model, PENALTY)
    shown = [(F.round(F.col("slopes")[k], 2) + 0.0).alias(n) for k, n in enumerate(names)]
    return slopes.select(F.coalesce("word", F.lit("")).alias("word"), "docs", *shown), model


@query(_slopes_sql("bad", "good"))
def ml_classifier(t: Tables) -> DataFrame:
    """A linear classifier of the quality flag on all words, at its optimum."""
    rows, cells = _rated(t, 2)
    return _slopes(rows, cells, sparse.one_of(F.col("quality_is")), ["bad", "good"])[0]


@query(
    f"""with {_bayes_sql()}
    select doc_id, round(margin, 3) as margin, cast(margin > 0 as integer) as pred from judged"""
)
def ml_bayes(t: Tables) -> DataFrame:
    """A naive Bayes classifier of the quality flag: log odds and prediction of each document."""
    margin = F.col("raw")[1] - F.col("raw")[0]
    return _bayes(t).select(
        "doc_id", F.round(margin, 3).alias("margin"), F.col("prediction").cast("int").alias("pred")
    )


@query(
    f"""with {_bayes_sql()}
    select 'quality' as run, 1 as epoch, 'train_loss' as metric,
           round(avg(greatest(m, 0) + ln(1 + exp(-abs(m)))), 4) as value
    from (select case when label = 1 then -margin else margin end as m from judged)"""
)
def ml_history(t: Tables) -> DataFrame:
    """The loss of a fitted model, from its written scores, as a row of its history."""
    loss = cross_entropy(F.col("raw"), F.col("label"))
    last = evaluate.mean_loss(_bayes(t), loss, "train_loss")
    rounded = last.withColumn("train_loss", F.round("train_loss", 4))
    return evaluate.history_rows(rounded, F.lit("quality"), F.lit(1), ["train_loss"])


EPOCHS, RATE = 3, 2.0


def _epoch_steps_sql() -> str:
    """Weights behind each batch: of a language, and of all rows under ''. The two classes move by opposite amounts."""
    steps = []
    for n in range(1, 2 * EPOCHS + 1):
        steps.append(f"""
scored_{n} as (
  select r.*, 1 / (1 + exp(-2 * (w.w + b.w))) as p from rows_ r
  join weights_{n - 1} w on w.f = r.f join weights_{n - 1} b on b.f = ''),
slopes_{n} as (
  select s.f, sum(s.p - s.y) / (select count(*) from scored_{n} where batch = {(n - 1) % 2}) as d
  from (select * from scored_{n} union all select * replace ('' as f) from scored_{n}) s
  where batch = {(n - 1) % 2} group by s.f),
weights_{n} as (
  select w.f, w.w - {RATE} * coalesce(d.d, 0) as w from weights_{n - 1} w left join slopes_{n} d on d.f = w.f)""")
    return ",".join(steps)


def _epoch_figures_sql() -> str:
    lines = [
        f"""select {e}::int as epoch, m.metric, round(m.value, 6) as value from (
      select avg(-ln(case when y = 1 then p else 1 - p end)) filter (where not held) as a,
             avg(-ln(case when y = 1 then p else 1 - p end)) filter (where held) as b,
             avg(((p > 0.5)::int = y)::int) filter (where held) as c
      from (select r.*, 1 / (1 + exp(-2 * (w.w + b.w))) as p from rows_ r
            join weights_{2 * e} w on w.f = r.f join weights_{2 * e} b on b.f = '')),
      lateral (values ('train_loss', a), ('valid_loss', b), ('valid_accuracy', c)) m(metric, value)"""
        for e in range(1, EPOCHS + 1)
    ]
    return " union all ".join(lines)


@query(
    f"""with {v.TRAINING_SQL},
rows_ as (
  select t.doc_id, t.quality as y, t.doc_id % 4 = 0 as held,
         case when t.doc_id % 4 <> 0 then t.doc_id % 2 end as batch, coalesce(d.lang, 'und') as f
  from training_rows t join documents d on d.doc_id = t.doc_id),
weights_0 as (select distinct f, 0.0::double as w from rows_ union all select '', 0.0),
{_epoch_steps_sql()}
select 'quality' as run, * from ({_epoch_figures_sql()})"""
)
def ml_epochs(t: Tables) -> DataFrame:
    """A fit over three epochs of two batches: losses and accuracy on held-out rows behind each, from its snapshot."""
    truth = F.when(F.col("quality") == 1, F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0)))
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), truth.alias("target"), (F.col("doc_id") % 4 == 0).alias("held_out"),
        F.coalesce("lang", F.lit("und")).alias("word"),
    )
    rows = materialize(rows, "rows")
    history, _ = sparse.train_epochs(
        rows.drop("word"), rows.select("doc_id", "word", F.lit(1.0).alias("value")), "doc_id",
        sparse.one_of(F.col("target")), lambda scores: cross_entropy(scores, F.col("label")), 2, EPOCHS, RATE,
        batch=F.col("doc_id") % 2,
    )
    shown = evaluate.history_rows(history, F.lit("quality"), F.col("epoch"), ["train_loss", "valid_loss", "valid_accuracy"])
    return shown.withColumn("value", F.round("value", 6))


@query(_slopes_sql("quality", "toxic"))
def ml_multi_label(t: Tables) -> DataFrame:
    """Both positions of a label in one model, fitted in the same passes, at its optimum."""
    rows, cells = _rated(t, 2)
    text = F.concat(F.lit("["), F.col("quality"), F.lit(","), F.col("toxic"), F.lit("]"))
    return _slopes(rows, cells, sparse.each_of(parse_multi_hot(text)), ["quality", "toxic"])[0]


@query(_slopes_sql("bad", "good", "civil", "toxic"))
def ml_two_targets(t: Tables) -> DataFrame:
    """Two classifiers on the same words, fitted in the same passes, at their optima."""
    rows, cells = _rated(t, 4)
    residual = sparse.side_by_side([F.col("quality_is"), F.col("toxic_is")], 2)
    return _slopes(rows, cells, residual, ["bad", "good", "civil", "toxic"])[0]


BOOST_RATE, BOOST_L2 = 0.5, 1.0
BOOST_LABEL_SQL = "case when toxic = 1 then 2 else quality end"


def _round_sql(n: int) -> str:
    """One round of one-split trees, one per class, on the margins of the round before."""
    last = f"margins_{n - 1}"
    return f"""
gradients_{n} as (
  select doc_id, class, weight * (p - (class = y)::int) as g, weight * p * (1 - p) as h from (
    select m.doc_id, m.class, r.y, r.weight, exp(m.m - max(m.m) over (partition by m.doc_id))
           / sum(exp(m.m - x.top)) over (partition by m.doc_id) as p
    from {last} m join (select doc_id, max(m) as top from {last} group by doc_id) x using (doc_id)
    join rows_ r on r.doc_id = m.doc_id)),
totals_{n} as (select class, sum(g) as g, sum(h) as h from gradients_{n} group by class),
sums_{n} as (
  select g.class, c.word, c.value, sum(g.g) as g, sum(g.h) as h
  from cells c join gradients_{n} g using (doc_id) group by all),
tried_{n} as (
  select s.class, word, coalesce(lag(value) over (partition by s.class, word order by value), 0.0) as border,
         sum(s.g) over above as gr, sum(s.h) over above as hr, t.g as g, t.h as h
  from sums_{n} s join totals_{n} t on t.class = s.class
  window above as (partition by s.class, word order by value desc)),
gains_{n} as (
  select *, g - gr as gl, h - hr as hl,
         round((g - gr) ** 2 / (h - hr + {BOOST_L2}) + gr ** 2 / (hr + {BOOST_L2}) - g ** 2 / (h + {BOOST_L2}), 9) as gain
  from tried_{n} where hr >= {boosting.LEAST} and h - hr >= {boosting.LEAST}),
best_{n} as (
  select * from gains_{n} where gain > 0
  qualify row_number() over (partition by class order by gain desc, word, border) = 1),
trees_{n} as (
  select class, word, border, -{BOOST_RATE} * gl / (hl + {BOOST_L2}) as low, -{BOOST_RATE} * gr / (hr + {BOOST_L2}) as high
  from best_{n}),
margins_{n} as (
  select m.doc_id, m.class,
         m.m + case when coalesce(c.value, 0) <= b.border then b.low else b.high end as m
  from {last} m join trees_{n} b on b.class = m.class
  left join cells c on c.doc_id = m.doc_id and c.word = b.word)"""


@query(
    f"""with {v.TRAINING_SQL},
rows_ as (
  select doc_id, {BOOST_LABEL_SQL} as y, 1.0 + doc_id % 3 as weight from training_rows),
cells as (
  select doc_id, word, least(count(*), 4)::double as value
  from (select doc_id, unnest({v.words_sql('lower(text)')}) as word from training_rows) group by all),
margins_0 as (select doc_id, class, 0.0::double as m from rows_, range(0, 3) c(class)),
{_round_sql(1)},{_round_sql(2)}
select n as round, class::int as class, word, border, round(low, 6) as low, round(high, 6) as high from (
  select 1 as n, * from trees_1 union all select 2, * from trees_2)"""
)
def ml_boosted_student(t: Tables) -> DataFrame:
    """Two rounds of boosted one-split trees over all words, for three classes of weighted rows."""
    bags = materialize(_bags(t).select("doc_id", "tokens", "quality", "toxic"), "bags")
    label = F.when(F.col("toxic") == 1, 2).otherwise(F.col("quality"))
    rows = bags.select("doc_id", label.alias("label"), (1.0 + F.col("doc_id") % 3).alias("weight"))
    counted = frames.items(bags, ["doc_id"], F.col("tokens"), "feature").groupBy("doc_id", "feature")
    cells = counted.agg(F.least(F.count("*"), F.lit(4)).cast("double").alias("value"))
    cells = materialize(cells, "cells")
    binned = boosting.binned(cells, rows, "doc_id")
    model = None
    for _ in range(2):
        model = boosting.boost(
            rows, cells, "doc_id", 3, rounds=1, depth=1, learning_rate=BOOST_RATE, l2=BOOST_L2, start=model, features=binned
        )
    trees = [
        (n, k, *tree.splits[1], tree.values[2], tree.values[3])
        for n, trees in enumerate(model.rounds, 1)
        for k, tree in enumerate(trees)
        if tree.splits
    ]
    shape = "round int, class int, word string, border double, low double, high double"
    return t.spark.createDataFrame(trees, shape).withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(
    f"""with {_bayes_sql('doc_id % 4 <> 0', shares=True)},
    first_round as (
      select 1 as round, doc_id, doc_id % 4 = 0 as held_out, cast(margin > 0 as integer) as teacher_pred,
             case when cast(margin > 0 as integer) = label then 1.0::double else 10.0::double end as weight
      from judged)
    select *, true as weighed from first_round
    union all
    select n, doc_id, held_out, null, null, true from first_round, range(2, 4) r(n)"""
)
def ml_co_training(t: Tables) -> DataFrame:
    """Two models that teach each other for three rounds, on all words.

    The first round's verdicts and weights by row; of the later ones, whose teacher learns from the student, whether
    each weight follows from the verdict.
    """
    bags = materialize(_bags(t).select("doc_id", "label", "tokens"), "bags")
    counted = frames.items(bags, ["doc_id"], F.col("tokens"), "word").groupBy("doc_id", "word")
    cells = materialize(counted.agg(F.count("*").cast("double").alias("value")), "cells")
    rows = bags.select("doc_id", "label", (F.col("doc_id") % 4 == 0).alias("held_out"))
    _, rounds = training.co_teach(rows, cells, "doc_id", 2, trees=1, depth=2)
    shown = []
    for n, found in enumerate(rounds, 1):
        right = F.col("weight") == F.when(F.col("teacher_pred") == F.col("label"), 1.0).otherwise(10.0)
        first = [F.when(F.lit(n == 1), F.col(c)).alias(c) for c in ("teacher_pred", "weight")]
        shown.append(found.select(F.lit(n).cast("long").alias("round"), "doc_id", "held_out", *first, right.alias("weighed")))
    return reduce(DataFrame.unionByName, shown)


@query(_slopes_sql("bad", "good"))
def ml_distilled(t: Tables) -> DataFrame:
    """A student of a teacher's scores at temperature 2 and of the truth, at its optimum."""
    rows, cells = _rated(t, 2)
    truth = F.col("quality_is")
    teacher = sparse.fit(rows, cells, "doc_id", sparse.one_of(truth), 2, PENALTY, steps=8)
    taught = sparse.scored(rows, cells, "doc_id", teacher).withColumnRenamed("scores", "teacher")
    residual = sparse.taught(F.col("teacher"), truth, alpha=0.7, temperature=2.0)
    return _slopes(materialize(taught, "taught"), cells, residual, ["bad", "good"])[0]


# --- explanation

COEFFICIENTS_SQL = f"""
rated as (
  select distinct d.doc_id, l.quality, unnest({v.words_sql('d.text')}) as word
  from documents d join labels l on d.doc_id = l.doc_id),
coefficients as (
  select word, ln((count(*) filter (where quality = 1) + 1.0) /
                  (count(*) filter (where quality = 0) + 1.0)) as coefficient
  from rated group by word),
counted as (
  select doc_id, word, count(*) as n
  from (select doc_id, unnest({v.words_sql('text')}) as word from documents) group by doc_id, word),
weights as (
  select w.doc_id, w.word, round(w.n * c.coefficient, 6) as weight
  from counted w join coefficients c on w.word = c.word)"""


def coefficients(t: Tables) -> DataFrame:
    """One coefficient per word: log odds of its documents being of good quality."""
    distinct = F.array_distinct(words(F.col("text")))
    rated = frames.items(v.training_rows(t), ["quality"], distinct, "word")
    odds = (F.count_if(F.col("quality") == 1) + 1.0) / (F.count_if(F.col("quality") == 0) + 1.0)
    return rated.groupBy("word").agg(F.ln(odds).alias("coefficient"), F.count("*").alias("rows"))


def _top(t: Tables) -> DataFrame:
    return explain.top_linear_words(
        t.documents, materialize(coefficients(t), "coefficients"), "doc_id", words(F.col("text")), digits=6
    )


@query(
    f"""with {COEFFICIENTS_SQL}
    select doc_id, word, weight from (
      select *, row_number() over (partition by doc_id order by abs(weight) desc, word) as n
      from weights)
    where n <= 6"""
)
def exp_word_weights(t: Tables) -> DataFrame:
    """What taking a word out costs, for a scorer that adds up word coefficients."""
    return _top(t)


EXP_ROWS_SQL = f"""with {COEFFICIENTS_SQL},
    top as (
      select doc_id, word, weight from (
        select *, row_number() over (partition by doc_id order by abs(weight) desc, word) as n
        from weights) where n <= 6)"""


def _listed(t: Tables) -> DataFrame:
    """The top words of each document as a list, as an explainer would return them."""
    pairs = F.collect_list(F.struct("word", "weight"))
    return _top(t).groupBy("doc_id").agg(explain.top_words_in_list(pairs).alias("words"))


@query(f"{EXP_ROWS_SQL} select doc_id, word, weight from top where length(word) >= 2")
def exp_all_words(t: Tables) -> DataFrame:
    return explain.word_rows(_listed(t))


@query(
    f"""{EXP_ROWS_SQL}
    select doc_id, word, weight from (
      select *, row_number() over (partition by word order by weight desc, doc_id desc) as n
      from top where length(word) >= 2)
    where n = 1"""
)
def exp_best_words(t: Tables) -> DataFrame:
    return explain.best_word_rows(_listed(t))


# Word lists per class of a scorer that is linear in the presence of words: a word counts its
# length, under class 1 negative.
@query(
    f"""with w as (
      select item_id, unnest(list_distinct({v.words_sql('text')})) as word from benchmark),
    weights as (
      select item_id, word, case when item_id % 2 = 1 then -length(word) else length(word) end as weight
      from w),
    ranked as (
      select *, row_number() over (partition by item_id order by abs(weight) desc, word) as n
      from weights)
    select item_id, cast(sum(weight) as double) as weight, count(*) as words
    from ranked where n <= 6 group by item_id"""
)
def exp_local_weights(t: Tables) -> DataFrame:
    """Words that drive a black-box scorer for the row's own class, from a local fit.

    The scorer adds up a known weight per word present, so with hardly any penalty the
    fit must find those weights; words of one weight are told apart by their sum only.
    """

    def score(text: Column) -> Column:
        lengths = F.transform(F.array_distinct(F.split(text, " ")), lambda w: F.length(w).cast("double"))
        total = F.aggregate(lengths, F.lit(0.0), lambda a, b: a + b)
        return F.array(total, -total)

    weights = explain.local_weights(
        t.benchmark.withColumn("class", (F.col("item_id") % 2).cast("int")),
        "item_id",
        words(F.col("text")),
        score,
        samples=300,
        target="class",
        ridge=1e-9,
        selection=explain.HEAVIEST,
    )
    return weights.select("item_id", F.explode("words").alias("w")).groupBy("item_id").agg(
        F.round(F.sum("w.weight"), 2).alias("weight"), F.count("*").alias("words")
    )


@query(
    f"""with w as (
      select item_id, unnest(list_distinct({v.words_sql('text')})) as word from benchmark),
    cues as (
      select word, row_number() over (order by count(*) desc, word) as place from w group by word
      qualify place <= 6)
    select item_id, word, cast(case when place % 2 = 1 then place else -place end as double) as weight
    from w join cues using (word)"""
)
def exp_selected_words(t: Tables) -> DataFrame:
    """Words found by forward selection for a scorer that looks at six cue words only.

    A text has some of them; the selection must take these and no other, whatever their weights.
    """
    bags = t.benchmark.select("item_id", F.array_distinct(words(F.col("text"))).alias("bag"))
    counted = frames.items(bags, [], F.col("bag"), "word").groupBy("word").agg(F.count("*").alias("n"))
    cues = [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(6).collect()]

    def score(text: Column) -> Column:
        held = F.split(text, " ")
        parts = [
            F.when(F.array_contains(held, cue), float(place if place % 2 else -place)).otherwise(0.0)
            for place, cue in enumerate(cues, 1)
        ]
        return F.aggregate(F.array(*parts), F.lit(0.0), lambda a, b: a + b)

    found = explain.local_weights(t.benchmark, "item_id", words(F.col("text")), score, samples=300, ridge=1e-9)
    each = found.select("item_id", F.explode("words").alias("w"))
    each = each.select("item_id", "w.word", F.round("w.weight", 4).alias("weight"))
    # the places that no cue fills go to words without a weight
    return each.where(F.col("weight") != 0)
