"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on a bounded labelled sample; every path from a root to a
node below it is a conjunction of bounds on statistics. A lasso logistic fit over
the rules keeps few of them, and those become one column expression: scoring
is a scan without Python, shuffle or broadcast.

NULL text counts as empty; all statistics of an empty text are 0. Without
labels of both kinds the score is the smoothed share of label 1 for every row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import is_held_out, labelled_sample, packed
from opinarium.runtime import materialize

# One condition: statistic, whether it is an upper bound, and the bound.
Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]

STATISTICS = [
    "chars", "words", "word_length", "capitals", "symbols", "loose", "numbers",
    "repeats", "distinct", "lines",
]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """One struct column `_stats` of text statistics; counts other than the first two are per word."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, r"\s+"), lambda w: w != "")
    count = F.greatest(F.size("_words"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / count

    neighbours = F.filter(
        F.col("_words"), lambda w, i: (i > 0) & (w == F.get("_words", i - 1))
    )
    stats = {
        "chars": F.length(value),
        "words": F.size("_words"),
        "word_length": F.length(value) / count,
        "capitals": share(r"\p{Lu}{2,}"),
        "symbols": share(r"[^\p{L}\p{N}\s]{2,}"),
        "loose": share(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)"),
        "numbers": share(r"\p{N}+"),
        "repeats": F.size(neighbours) / count,
        "distinct": F.size(F.array_distinct("_words")) / count,
        "lines": share(r"\n"),
    }
    row = F.struct(*[stats[name].cast("double").alias(name) for name in STATISTICS])
    # The row number, which is always there, keeps the optimizer from copying the statistics into
    # each rule that reads them, and a filter on the score from going below them.
    once = F.when(F.monotonically_increasing_id() >= 0, row)
    return df.withColumn("_words", words).withColumn("_stats", once).drop("_words")


def _simplified(path: list[Condition]) -> Rule:
    """The tightest bounds of a path, one per statistic and side, in a fixed order."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, upper, bound in path:
        known = bounds.get((name, upper), bound)
        bounds[name, upper] = min(known, bound) if upper else max(known, bound)
    return tuple(sorted((name, upper, bound) for (name, upper), bound in bounds.items()))


def tree_rules(trees) -> list[Rule]:
    """The distinct conjunctions on the paths of fitted trees."""
    found: set[Rule] = set()
    for tree in trees:
        open_nodes = [(tree._java_obj.rootNode(), [])]
        while open_nodes:
            node, path = open_nodes.pop()
            if path:
                found.add(_simplified(path))
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                name, bound = STATISTICS[split.featureIndex()], float(split.threshold())
                open_nodes.append((node.leftChild(), [*path, (name, True, bound)]))
                open_nodes.append((node.rightChild(), [*path, (name, False, bound)]))
    return sorted(found)


def rule_column(rule: Rule) -> Column:
    """1.0 where all bounds of the rule hold, else 0.0."""
    held = F.lit(True)
    for name, upper, bound in rule:
        value = F.col(f"_stats.{name}")
        held = held & (value <= bound if upper else value > bound)
    return held.cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; `column` is the probability over the struct `_stats`."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.lit(weight) * rule_column(rule)
        return 1.0 / (1.0 + F.exp(-total))


def fit(
    sample: DataFrame, trees: int = 24, depth: int = 3, lasso: float = 5e-4, seed: int = 9
) -> RuleEnsemble:
    """Rules of `sample` (text, label 0 or 1), a bounded frame."""
    rows = materialize(with_statistics(sample).select("_stats", "label"), "statistics")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return RuleEnsemble((), math.log(share / (1 - share)))
    vector = array_to_vector(F.array(*[F.col(f"_stats.{name}") for name in STATISTICS]))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird",
        minInstancesPerNode=3,
    )
    rules = tree_rules(forest.fit(rows.select(vector.alias("features"), "label")).trees)
    if not rules:
        share = ones / n
        return RuleEnsemble((), math.log(share / (1 - share)))
    fired = array_to_vector(F.array(*[rule_column(rule) for rule in rules]))
    linear = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100)
    model = linear.fit(rows.select(fired.alias("features"), "label"))
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients, strict=True) if abs(w) > 1e-6]
    return RuleEnsemble(tuple(kept), float(model.intercept))


def score(docs: DataFrame, model: RuleEnsemble, threshold: float = 0.3) -> DataFrame:
    """`docs` with `_score` in [0, 1] and `_predicted`; the caller renames them."""
    scored = with_statistics(docs).withColumn("_score", model.column()).drop("_stats")
    return scored.withColumn("_predicted", (F.col("_score") >= threshold).cast("int"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    threshold: float = 0.3,
    sample_rows: int = 20_000,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Trained on `sample_rows` labelled documents at most, none of fold `held_out`;
    ids, languages, sources and labels are no inputs of the score.
    """
    sample = labelled_sample(docs, labels, "quality", folds, held_out, sample_rows)
    scored = score(docs.select("doc_id", "text"), fit(sample), threshold)
    return scored.select(
        "doc_id",
        is_held_out(folds, held_out).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    sample = labelled_sample(docs, labels, "quality", 5, 0, sample_rows)
    kept = score(packed(docs, "text"), fit(sample)).where("_predicted = 1")
    return kept.select("row.*")
