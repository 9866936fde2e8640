"""URL filters: rules first, then naive Bayes over segmented host names.

A host label such as `cheappills` is split into words by Viterbi under a unigram model whose
counts come from the visible text of all pages; the words of hosts and paths, counted over all pages, feed a
multinomial naive Bayes model. Its training verdicts are seeds: pages whose
host holds a seed word are bad, the others good; the model then judges by all words that go with
them, and only pages without a rule are judged by it.

The segmentation looks up only the substrings that occur in some host, by a join, so the vocabulary has
no limit. Word weights are a table too, a row per word, which is joined to the words of the pages.

A NULL url, or one without `://`, has an empty host and path, matches no rule and is judged by
the prior alone. Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.runtime import broadcast_if_small, materialize

# Fixed values: (host, path, verdict) of the rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# Seed words of bad hosts.
SEEDS = [
    "ads", "adult", "bet", "bets", "casino", "cheap", "drugs", "farm", "loan", "loans",
    "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "track", "viagra", "warez", "win", "xxx",
]

LONGEST_WORD = 24
NUMBER = "<number>"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, ASCII letters lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it and starts the path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: len(r[0]) + len(r[1]))
    for domain, start, decision in ordered:  # the longest is asked first
        fits = (host == domain) | host.endswith(f".{domain}")
        fits = fits & path.startswith(start)
        name = F.when(fits, F.lit(domain + start)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) over the visible text of all pages: letters only, lower-cased."""
    seen = F.regexp_replace(F.col("html"), r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = F.regexp_extract_all(F.lower(seen), F.lit(r"\p{L}+"), 0)
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def label_words(label: str, weights: dict[str, float], unknown: float) -> list[str]:
    """The most probable words of a letter run; an unknown letter costs `unknown`.

    Neighbouring unknown letters are joined. Ties go to the longer last word.
    """
    size = len(label)
    best = [0.0] + [-math.inf] * size
    back: list[tuple[int, bool]] = [(0, False)] * (size + 1)
    for end in range(1, size + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            weight = weights.get(label[start:end])
            known = weight is not None
            if not known:
                weight = unknown if end - start == 1 else None
            if weight is not None and best[start] + weight > best[end]:
                best[end], back[end] = best[start] + weight, (start, known)
    words, end = [], size
    loose = ""
    while end:
        start, known = back[end]
        if known:
            if loose:
                words.append(loose)
            words.append(label[start:end])
            loose = ""
        else:
            loose = label[start:end] + loose
        end = start
    if loose:
        words.append(loose)
    return words[::-1]


def segment_hosts(hosts: DataFrame, counts: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """(host, words) of distinct hosts; digits become a number word, other signs only separate.

    A seed word is in the vocabulary even if no page's text has it.
    """
    spark = hosts.sparkSession
    runs = hosts.select(
        "host", F.posexplode(F.regexp_extract_all("host", F.lit(r"\p{L}+|\p{N}+"), 0)).alias("place", "run")
    )
    labels = materialize(
        runs.where(F.col("run").rlike(r"^\p{L}")).select(F.col("run").alias("label")).distinct(), "labels"
    )
    place = F.explode(F.sequence(F.lit(1), F.length("label")))
    parts = labels.select("label", place.alias("from")).select(
        "label",
        F.explode(
            F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("from") + 1))
        ).alias("size"),
        "from",
    )
    parts = parts.select("label", F.substring("label", F.col("from"), F.col("size")).alias("word")).distinct()
    known = spark.createDataFrame([(s, 1) for s in seeds], "word string, n long")
    vocabulary = counts.unionByName(known).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(vocabulary.where((F.length("word") > 1) | (F.col("n") > 1)), "vocabulary")
    total = max(vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], 1)
    weight = F.log(F.col("n") / total)
    found = parts.join(vocabulary, "word").select("label", F.struct("word", weight.alias("w")).alias("unit"))
    found = found.groupBy("label").agg(F.collect_list("unit").alias("units"))
    found = labels.join(found, "label", "left")
    unknown = math.log(1 / total) - 2.0

    @F.pandas_udf("array<string>")
    def split(labels: pd.Series, units: pd.Series) -> pd.Series:
        out = []
        for label, known_units in zip(labels, units, strict=True):
            weights = {u["word"]: u["w"] for u in known_units} if known_units is not None else {}
            out.append(label_words(label, weights, unknown))
        return pd.Series(out)

    words = materialize(found.select("label", split("label", "units").alias("words")), "segments")
    joined = runs.join(words, runs["run"] == words["label"], "left").select(
        "host", "place", F.coalesce("words", F.array(F.lit(NUMBER))).alias("words")
    )
    ordered = joined.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("all"))
    return ordered.select("host", F.flatten(F.col("all.words")).alias("words"))


def path_words(path: Column) -> Column:
    """Letter runs, lower-cased, and a number word for each digit run."""
    runs = F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|\p{N}+"), 0)
    return F.transform(runs, lambda r: F.when(r.rlike(r"^\p{N}"), F.lit(NUMBER)).otherwise(r))


def bayes_weights(rows: DataFrame) -> tuple[float, DataFrame]:
    """(prior, table (word, bad, good, weight)) as log odds for bad, from (bad, words), all pages."""
    bad, good = rows.agg(
        F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0))
    ).first()
    counted = (
        rows.select("bad", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    )
    counted = materialize(counted, "url-words")
    width, *totals = counted.agg(
        F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))
    ).first()
    smoothed = 0.5 * max(width, 1)
    shares = [F.log((F.col(c) + 0.5) / (n + smoothed)) for c, n in zip(("bad", "good"), totals, strict=True)]
    return math.log((bad + 1) / (good + 1)), counted.withColumn("weight", shares[0] - shares[1])


def bayes_scores(rows: DataFrame, prior: float, weights: DataFrame) -> DataFrame:
    """(_row, score): the probability of a bad page, of the rows (_row, words) that have words."""
    words = rows.select("_row", F.explode("words").alias("word"))
    found = words.join(broadcast_if_small(weights.select("word", "weight")), "word")
    # sorted, so that the order of rows does not matter to the sum
    listed = found.groupBy("_row").agg(F.sort_array(F.collect_list("weight")).alias("weights"))
    total = F.aggregate("weights", F.lit(prior), lambda a, b: a + b)
    return listed.select("_row", _probability(total).alias("score"))


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-500.0)), F.lit(500.0))))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    seeds: Sequence[str] = SEEDS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) of every page.

    `score` is the model's probability of a bad page, whether or not a rule decides.
    """
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = rows.where("host != ''").groupBy("host").agg(F.count("*").alias("n")).select("host")
    segments = materialize(segment_hosts(hosts, word_counts(pages), seeds), "hosts")
    spread = rows.join(segments, "host", "left").select(
        "page_id", "host", "path",
        F.coalesce("words", F.array().cast("array<string>")).alias("host_words"),
        path_words(F.col("path")).alias("path_words"),
    )
    bad = F.arrays_overlap("host_words", F.array(*[F.lit(s) for s in seeds])).cast("int")
    spread = materialize(
        spread.select(
            "page_id", "host", "path", bad.alias("bad"), F.monotonically_increasing_id().alias("_row"),
            F.concat("host_words", "path_words").alias("words"), "host_words",
        ),
        "words",
    )
    prior, weights = bayes_weights(spread)
    name, verdict = rule_of(rules, F.col("host"), F.col("path"))
    scores = bayes_scores(spread, prior, weights)
    judged = spread.join(scores, "_row", "left").withColumn(
        "score", F.coalesce("score", _probability(F.lit(prior)))
    )
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "score", F.col("host_words").alias("words"),
    )
