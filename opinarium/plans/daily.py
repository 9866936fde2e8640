"""The daily opinion job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions import fixed_values as fixed
from opinarium.functions.text import clean_strict, split_sentences, whole_text_sentence
from opinarium.operators.dedup import keep_first
from opinarium.operators.frames import any_flag, drop_failures, flatten, once
from opinarium.operators.joins import select_articles, selected_copies
from opinarium.operators.rules import GRAMS, find_hits, match_rules
from opinarium.operators.sampling import capped_sample
from opinarium.operators.scoring import decode_label
from opinarium.runtime import materialize
from opinarium.sources.warehouse import read_day

CLASS_FLAGS = ["class2_label", "class3_label", "class4_label", "class5_label"]


@dataclass(frozen=True)
class Variant:
    """What the variants of the job do differently."""

    # one row per article, however often the filter tables hold it
    semi: bool = False
    # None keeps sentences of any length, untrimmed
    min_sentence: int | None = 10
    # cut at end marks, or take the alphanumeric text as one sentence
    whole_texts: bool = False
    dedup_articles: bool = True
    dedup_sentences: bool = False
    # rows must be longer than this after splitting; None keeps all
    min_text: int | None = 5
    # "keep": rows without a rule hit stay; "drop": they go and a row is made per hit; None
    rules: str | None = "keep"
    # predictions a row must have; without another one it stays, with an empty label
    required: tuple[str, ...] = ("property", "emotion")
    # sample cap over all strata; None keeps all rows
    total: int | None = None


FULL = Variant()
TWO_HEADS = Variant(
    rules=None, dedup_sentences=True, required=("emotion",), total=fixed.SAMPLE_TOTAL
)
HITS_ONLY = replace(TWO_HEADS, rules="drop", min_sentence=None)
WHOLE_TEXTS = Variant(
    whole_texts=True,
    dedup_articles=False,
    min_text=None,
    rules=None,
    total=fixed.SAMPLE_TOTAL,
)


def _day_filters(
    correlation: DataFrame, classified: DataFrame, day: str, labels: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The day's relevant and classified rows."""
    relevant = read_day(correlation, day).where(F.col("label").isin(list(labels)))
    return relevant, read_day(classified, day).where(any_flag(CLASS_FLAGS))


def articles_of_day(
    news: DataFrame,
    correlation: DataFrame,
    classified: DataFrame,
    day: str,
    labels: Sequence[str],
    semi: bool = False,
) -> DataFrame:
    """(news_uuid, news_content) of the day's relevant, classified articles."""
    relevant, flagged = _day_filters(correlation, classified, day, labels)
    articles = read_day(news, day).select("news_uuid", "news_content")
    return select_articles(articles, relevant, flagged, semi=semi)


def article_lists(articles: DataFrame, variant: Variant = FULL) -> DataFrame:
    """(news_uuid, text, sentences): the list of sentences of each article kept, and its size."""
    split = whole_text_sentence if variant.whole_texts else split_sentences
    found = articles.select(
        "news_uuid", split(F.col("news_content"), variant.min_sentence).alias("text")
    ).withColumn("sentences", F.size("text"))
    if not variant.dedup_articles:
        return found
    # the size rides along as a value: a filter on the list itself would be pushed below the
    # aggregate and split every article twice
    return keep_first(found, ["text"], ["news_uuid"]).where(F.col("sentences") > 0)


def spread_lists(lists: DataFrame, variant: Variant = FULL) -> DataFrame:
    """(text, news_uuid, position): one row per sentence."""
    rows = flatten(lists.select("news_uuid", "text"), ["text"], position="position")
    if variant.min_text is not None:
        rows = rows.where(F.length("text") > variant.min_text)
    if variant.dedup_sentences:
        # the score depends on the text alone: drop copies before scoring, not behind it
        rows = keep_first(rows, ["text"], ["news_uuid", "position"])
    return rows


def sentence_rows(articles: DataFrame, variant: Variant = FULL) -> DataFrame:
    """(text, news_uuid, position): one row per sentence of the articles kept."""
    return spread_lists(article_lists(articles, variant), variant)


def tagged_rows(
    sentences: DataFrame, rules: DataFrame | None, variant: Variant = FULL, rule_way: str = GRAMS
) -> DataFrame:
    """Sentences with their rule hits, where the variant has rules."""
    if variant.rules is None:
        return sentences
    return match_rules(sentences, rules, keep_all=variant.rules == "keep", way=rule_way)


def labelled_rows(
    sentences: DataFrame,
    scores: Callable[[Column], Column],
    property_names: Sequence[str],
    emotion_names: Sequence[str] = fixed.EMOTION_NAMES,
    clean: Callable[[Column], Column] = clean_strict,
    scoring_tasks: int | None = None,
) -> DataFrame:
    """Rows with the names of their classes; NULL marks a failed prediction.

    `scores` maps the cleaned text to a struct with a property and an emotion
    vector. `scoring_tasks` deals the sentences out evenly over that many tasks first: worth a
    shuffle when the model is slow, as tasks sized for text hold very many sentences.
    """
    if scoring_tasks is not None:
        sentences = sentences.repartition(scoring_tasks)
    # a row without a text, from an article without sentences, is a failed prediction
    cleaned = sentences.withColumn("_clean", once(clean(F.col("text"))))
    vectors = F.when(F.col("text").isNotNull(), scores(F.col("_clean")))
    scored = cleaned.withColumn("_scores", once(vectors)).drop("_clean")
    return (
        scored.withColumn("property", decode_label(F.col("_scores.property"), property_names))
        .withColumn("emotion", decode_label(F.col("_scores.emotion"), emotion_names))
        .drop("_scores")
    )


def final_rows(
    labelled: DataFrame,
    day: str,
    variant: Variant = FULL,
    draw_order: Sequence[str | Column] | None = None,
    written: bool = False,
) -> DataFrame:
    """Rows in the layout of the opinion table.

    Rows with a failed prediction go, or stay with an empty label where the variant does not
    require it. With a sample cap the labelled stage is written, as it is read twice and must
    not be scored twice, unless it is `written` already; `draw_order` replaces the seeded draw.
    """
    rows = drop_failures(labelled, variant.required)
    rows = rows.fillna("", subset=["property", "emotion"])
    if variant.total is not None:
        rows = capped_sample(
            rows if written else materialize(rows, "scored"),
            ["property", "emotion"],
            ["news_uuid", "position"],
            variant.total,
            order=draw_order,
        )
    rows = rows.withColumn("datatime", F.lit(day))
    if variant.rules == "drop":
        rows = flatten(rows, ["hits"])
    return rows.select(*[c for c in fixed.OPINION_COLUMNS if c in rows.columns])


def daily_opinions(
    news: DataFrame,
    correlation: DataFrame,
    classified: DataFrame,
    day: str,
    labels: Sequence[str],
    scores: Callable[[Column], Column],
    property_names: Sequence[str],
    rules: DataFrame | None = None,
    variant: Variant = FULL,
    scoring_tasks: int | None = None,
    rule_way: str = GRAMS,
    draw_order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """From the day's warehouse tables to opinion rows.

    Where articles are de-duplicated anyway they are selected by a semi join, so the
    copies that the filter tables would make are never made.
    """
    semi = variant.semi or variant.dedup_articles
    articles = articles_of_day(news, correlation, classified, day, labels, semi)
    tagged = tagged_rows(sentence_rows(articles, variant), rules, variant, rule_way)
    labelled = labelled_rows(tagged, scores, property_names, scoring_tasks=scoring_tasks)
    return final_rows(labelled, day, variant, draw_order)


def daily_with_counts(
    news: DataFrame,
    correlation: DataFrame,
    classified: DataFrame,
    day: str,
    labels: Sequence[str],
    scores: Callable[[Column], Column],
    property_names: Sequence[str],
    rules: DataFrame | None = None,
    variant: Variant = FULL,
    scoring_tasks: int | None = None,
    rule_way: str = GRAMS,
    draw_order: Sequence[str | Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The opinion rows and a summary (stage, row_count) of the run.

    Stages: rows of the query, with the copies that the filter tables make; articles kept;
    sentences; rows behind the rules; failed predictions; final rows. One stage is written, the labelled rows,
    and counted in one pass: rows that a step takes out stay in it without their text, so neither rules nor
    model see them, and carry what they count for. The opinion rows are read from it.
    """
    relevant, flagged = _day_filters(correlation, classified, day, labels)
    keys = read_day(news, day).select("news_uuid")
    semi = variant.semi or variant.dedup_articles
    articles = articles_of_day(news, correlation, classified, day, labels, semi)
    rows = _counted_rows(article_lists(articles, variant), variant)
    if variant.rules is not None:
        rows = find_hits(rows, rules, way=rule_way)
        if variant.rules == "drop":
            rows = rows.withColumn("_passed", F.col("_passed") & (F.size("hits") > 0))
            rows = rows.withColumn("text", F.when(F.col("_passed"), F.col("text")))
        else:
            rows = rows.withColumn("hits", F.array_join("hits", ", "))
    labelled = labelled_rows(rows, scores, property_names, scoring_tasks=scoring_tasks)
    labelled = materialize(labelled, "labelled")
    passed = labelled.where("_passed").drop(*COUNTERS)
    final = final_rows(passed, day, variant, draw_order, written=True)
    query = selected_copies(keys, relevant, flagged).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("query"))
    failed = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in variant.required])
    counts = labelled.agg(
        F.coalesce(F.sum("_articles"), F.lit(0)).alias("articles"),
        F.count_if("_sentence").alias("sentences"),
        F.count_if("_passed").alias("rules"),
        F.count_if(F.col("_passed") & failed).alias("failed"),
        F.count_if(F.col("_passed") & ~failed).alias("final"),
    )
    if variant.total is not None or variant.rules == "drop":
        counts = counts.drop("final").crossJoin(final.agg(F.count("*").alias("final")))
    lines = [
        df.select(F.explode(F.array(*[_line(c) for c in df.columns])).alias("l")).select("l.*")
        for df in (query, counts)
    ]
    return final, reduce(DataFrame.unionByName, lines)


COUNTERS = ["_articles", "_sentence", "_passed"]


def _line(stage: str) -> Column:
    return F.struct(F.lit(stage).alias("stage"), F.col(stage).cast("long").alias("row_count"))


def _counted_rows(lists: DataFrame, variant: Variant) -> DataFrame:
    """The rows of `spread_lists`, and those it takes out without a text, with `COUNTERS`.

    An article counts with its first row. Copies of a sentence are one row that counts for the articles of all; what is
    too short, or no sentence, is one such row.
    """
    rows = flatten(lists.select("news_uuid", "text"), ["text"], position="position")
    first = F.coalesce(F.col("position"), F.lit(0)) == 0
    kept = F.lit(True) if variant.min_text is None else F.coalesce(F.length("text") > variant.min_text, F.lit(False))
    rows = rows.select(
        F.when(kept, F.col("text")).alias("text"), "news_uuid", "position",
        first.cast("long").alias("_articles"), kept.alias("_sentence"),
    )
    if variant.dedup_sentences:
        grouped = rows.groupBy("text", "_sentence").agg(
            F.min(F.struct("news_uuid", "position")).alias("_row"), F.sum("_articles").alias("_articles")
        )
        rows = grouped.select("text", "_row.*", "_articles", "_sentence")
    return rows.withColumn("_passed", F.col("_sentence"))
