"""Toxicity: a weighted finite-state grammar over clauses.

Four small transducers read the word classes of a clause side by side: insults (whose
words and weights are learned), targets, negation and reported speech. Their
composition is one deterministic machine; its run over a clause sums the weights of
insults and threats, each lowered while a negation is near or the clause reports
someone else's words, insults raised once a target was named. A threat counts in a clause that
names a target or holds an insult, before or behind it. A logistic fit over the clause scores and the
threats of a document gives its probability.

The insult lexicon holds whole words and word beginnings (two letters more than the
beginning at least), so that inflected forms are found. A unit enters it when its share of
toxic documents is far beyond chance, counted over distinct texts of the training sample.

NULL and empty texts match no clause and get the score of a document without
a match. Without a lexicon threats are still weighed. Without labels of both kinds the score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import is_held_out, labelled_sample, packed
from opinarium.llm.near_duplicates import text_classes, text_key
from opinarium.runtime import materialize

# Closed-class words of the four languages of the tables.
TARGETS = (
    "you your yours yourself he she they them him her his their "
    "du dich dir dein deine ihr euch euer sie "
    "tu te toi ton ta tes vous votre vos il elle ils elles "
    "tú ti tuyo usted ustedes vosotros él ella ellos ellas"
).split()
NEGATIONS = (
    "not no never neither nor without hardly n't "
    "nicht kein keine keinen nie niemals ohne "
    "pas jamais aucun aucune ni sans "
    "nunca jamás tampoco ningún ninguna sin"
).split()
REPORTS = (
    "said says say claimed claims called wrote writes reported according quoted "
    "sagte sagt behauptet behauptete schrieb laut zitiert "
    "dit disait affirme affirma écrit selon "
    "dijo dice afirma afirmó escribió según"
).split()
THREATS = (
    "kill hurt destroy beat burn shoot stab strangle punish "
    "töten umbringen schlagen verbrennen erschießen "
    "tuer frapper brûler détruire "
    "matar golpear quemar destruir"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
NEGATION_REACH = 3
PREFIXES = (3, 4, 5, 6)

TOKEN = re.compile(r"[^\W\d_]+|[.,;:!?\n]|[\"“”«»„]")
CLAUSE_ENDS = frozenset(".,;:!?\n")
QUOTES = frozenset("\"“”«»„")


@dataclass(frozen=True)
class Transducer:
    """A finite-state machine: next state and factor by state and word class."""

    start: int
    states: int
    step: Callable[[int, int], tuple[int, float]]


def _negation(state: int, symbol: int) -> tuple[int, float]:
    """Counts down the words a negation still reaches; it lowers what it reaches."""
    after = NEGATION_REACH if symbol == NEGATION else max(state - 1, 0)
    return after, 0.6 if state and symbol in (INSULT, THREAT) else 1.0


def _report(state: int, symbol: int) -> tuple[int, float]:
    """0 plain, 1 after a verb of saying, 2 within quotation marks, 3 both."""
    after = state | 1 if symbol == REPORT else state ^ 2 if symbol == QUOTE else state
    return after, 0.7 if state and symbol in (INSULT, THREAT) else 1.0


def _target(state: int, symbol: int) -> tuple[int, float]:
    """Remembers that somebody was named; what is said afterwards counts more."""
    return int(state or symbol == TARGET), 1.25 if state and symbol == INSULT else 1.0


def _insult(state: int, symbol: int) -> tuple[int, float]:
    """Insults upon insults weigh a little more, twice at most."""
    if symbol == INSULT:
        return min(state + 1, 2), 1.0 + 0.1 * state
    return state, 1.0


GRAMMAR = (
    Transducer(0, 3, _insult),
    Transducer(0, 2, _target),
    Transducer(0, NEGATION_REACH + 1, _negation),
    Transducer(0, 4, _report),
)


def compose(machines: tuple[Transducer, ...]) -> dict[tuple[int, int], tuple[int, float]]:
    """The product machine over reachable states; state 0 is its start, factors multiply."""
    names = {tuple(m.start for m in machines): 0}
    table: dict[tuple[int, int], tuple[int, float]] = {}
    todo = list(names)
    while todo:
        state = todo.pop()
        for symbol in range(QUOTE + 1):
            steps = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            after = tuple(s for s, _ in steps)
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            table[names[state], symbol] = (names[after], math.prod(f for _, f in steps))
    return table


CLASSES = {
    word: kind
    for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS))
    for word in words
} | {mark: QUOTE for mark in QUOTES}


class ClauseScorer:
    """Scores of the clauses of a text under a lexicon of units `=word` and `beginning-`."""

    WORDS_KEPT = 200_000  # of the memory of word classes, which is dropped when full

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.machine = compose(GRAMMAR)
        self._known: dict[str, tuple[int, float]] = {}

    def classify(self, token: str) -> tuple[int, float]:
        """Word class and weight of a lower-case token."""
        weight = max(
            [self.lexicon.get(f"={token}", 0.0)]
            + [self.lexicon.get(f"{token[:n]}-", 0.0) for n in PREFIXES if len(token) >= n + 2]
        )
        if weight > 0:
            return INSULT, weight
        kind = CLASSES.get(token, OTHER)
        return kind, 1.0 if kind == THREAT else 0.0

    def clauses(self, text: str) -> list[tuple[float, float]]:
        """(score, part of it that is threats) of the clauses with a positive score, in order."""
        known, found = self._known, []
        tokens = TOKEN.findall(text.lower())
        if len(known) > self.WORDS_KEPT:
            known.clear()
        hit = False
        for token in tokens:
            if token not in known:
                known[token] = self.classify(token)
            hit = hit or known[token][1] > 0
        if not hit:
            return found
        state, insults, threats, aimed = 0, 0.0, 0.0, False
        for token in [*tokens, "."]:
            if token in CLAUSE_ENDS:
                threats = threats if aimed else 0.0
                if insults + threats > 0:
                    found.append((insults + threats, threats))
                state, insults, threats, aimed = 0, 0.0, 0.0, False
                continue
            symbol, weight = known[token]
            state, factor = self.machine[state, symbol]
            if symbol == THREAT:
                threats += weight * factor
            elif weight:
                insults += weight * factor
            aimed = aimed or symbol in (INSULT, TARGET)
        return found

    def __call__(self, text: str) -> list[float]:
        """The positive clause scores, in order."""
        return [score for score, _ in self.clauses(text)]

    def features(self, text: str | None) -> list[float]:
        """Best clause, all clauses (logarithm), the second best clause, and all threats (logarithm)."""
        clauses = self.clauses(text) if text else []
        scores = sorted((score for score, _ in clauses), reverse=True)
        second = scores[1] if len(scores) > 1 else 0.0
        threats = sum(threat for _, threat in clauses)
        return [scores[0] if scores else 0.0, math.log1p(sum(scores)), second, math.log1p(threats)]


FEATURES = 4


def with_features(df: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """Column `_features` next to the others, from column `text`."""
    shared = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = ClauseScorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.features(text) for text in texts])

    # a filter on a deterministic score would be pushed below it, together with a second run
    return df.withColumn("_features", features.asNondeterministic()("text"))


def learn_lexicon(
    sample: DataFrame, evidence: float = 12.0, least_odds: float = 1.5, units: int = 50_000
) -> dict[str, float]:
    """Units of the training sample whose presence speaks for toxicity, with log odds.

    `evidence` bounds the log-likelihood gain over the base rate from below, so that
    words of one long text don't enter. Near copies of a text share the weight of one, so a
    family of copies is no evidence of its own, and no text is left out. At most `units`, the strongest.
    """
    letters = F.lit(r"[^\W\d_]+".replace(r"[^\W\d_]", r"\p{L}"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), letters, 0))
    texts = sample.select(text_key().alias("key"), "label", words.alias("words"))
    texts = materialize(texts.dropDuplicates(["key", "label"]), "toxic-words")
    placed = texts.select("key", "label").join(text_classes(sample), "key")
    sizes = placed.groupBy("class_key").agg((1.0 / F.count("*")).alias("weight"))
    weights = materialize(placed.join(sizes, "class_key").select("key", "label", "weight"), "toxic-weights")
    n, ones = weights.agg(
        F.coalesce(F.sum("weight"), F.lit(0.0)), F.coalesce(F.sum(F.col("weight") * F.col("label")), F.lit(0.0))
    ).first()
    if not 0 < ones or weights.where("label = 0").isEmpty():
        return {}
    word = texts.join(F.broadcast(weights), ["key", "label"]).select(
        "key", "label", "weight", F.explode("words").alias("word")
    )
    forms = [F.concat(F.lit("="), "word")] + [
        F.when(F.length("word") >= k + 2, F.concat(F.substring("word", 1, k), F.lit("-")))
        for k in PREFIXES
    ]
    # sums of a text's share are rounded, so that their order does not matter
    toxic = F.round(F.sum(F.col("weight") * F.col("label")), 9)
    unit = (
        word.select("key", "label", "weight", F.explode(F.array(*forms)).alias("unit"))
        .where("unit is not null")
        .distinct()
        .groupBy("unit")
        .agg(toxic.alias("a"), F.round(F.sum("weight"), 9).alias("m"))
        .where("a >= 3")
    )
    base = ones / n
    q = F.col("a") / F.col("m")
    gain = F.col("m") * (
        q * F.log(q / base)
        + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - base))).otherwise(0.0)
    )
    odds = F.log((F.col("a") + 0.5) / (ones + 1)) - F.log(
        (F.col("m") - F.col("a") + 0.5) / (n - ones + 1)
    )
    strong = (
        unit.withColumn("odds", odds)
        .where((q > base) & (gain >= evidence) & (F.col("odds") >= least_odds))
        .orderBy(F.desc(gain), "unit")
        .limit(units)
    )
    return {r["unit"]: r["odds"] for r in strong.select("unit", "odds").collect()}


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for i, weight in enumerate(self.weights):
            total = total + F.lit(weight) * F.get("_features", F.lit(i))
        return 1.0 / (1.0 + F.exp(-total))


def fit(sample: DataFrame) -> Model:
    """Lexicon and clause weights of `sample` (text, label 0 or 1), a bounded frame."""
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, n):
        share = (ones + 1) / (n + 2)
        return Model({}, (0.0,) * FEATURES, math.log(share / (1 - share)))
    lexicon = learn_lexicon(sample)
    rows = materialize(
        with_features(sample.select("text", "label"), lexicon).select("_features", "label"),
        "clauses",
    )
    linear = LogisticRegression(regParam=1e-4, maxIter=200)
    model = linear.fit(rows.select(array_to_vector("_features").alias("features"), "label"))
    return Model(lexicon, tuple(float(w) for w in model.coefficients), float(model.intercept))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """`docs` with `_score` in [0, 1] and `_predicted`."""
    scored = with_features(docs, model.lexicon).withColumn("_score", model.column())
    return scored.drop("_features").withColumn(
        "_predicted", (F.col("_score") >= threshold).cast("int")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    held_out: int = 1,
    threshold: float = 0.7,
    sample_rows: int = 20_000,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Trained on `sample_rows` labelled documents at most, none of fold `held_out`;
    ids, languages, sources and labels are no inputs of the score.
    """
    sample = labelled_sample(docs, labels, "toxic", folds, held_out, sample_rows)
    scored = score(docs.select("doc_id", "text"), fit(sample), threshold)
    return scored.select(
        "doc_id",
        is_held_out(folds, held_out).alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
    )


def keep_civil(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> DataFrame:
    """The documents that are not judged toxic, with their columns."""
    sample = labelled_sample(docs, labels, "toxic", 3, 1, sample_rows)
    kept = score(packed(docs, "text"), fit(sample)).where("_predicted = 0")
    return kept.select("row.*")
