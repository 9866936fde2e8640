"""Which words drive a prediction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opinarium.functions import fixed_values as fixed
from opinarium.operators.dedup import best_words, top_rows
from opinarium.operators.frames import flatten, items
from opinarium.runtime import SMALL_CHARS, SMALL_ROWS, broadcast_if_small, is_small, materialize

# Width of the weighting kernel, and ridge penalty of the local model.
KERNEL_WIDTH = 25.0
RIDGE = 1.0

# Rows whose words are counted in one task.
PART_ROWS = 4096

# How the words of a local model are chosen; what counts as nothing next to a whole.
FORWARD, HEAVIEST = "forward", "heaviest"
NOTHING = 1e-9


def linear_word_weights(df: DataFrame, coefficients: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, word, weight): what the score loses when a word is taken out.

    For a scorer that adds up one coefficient per word this is occurrences times
    coefficient, so no variant of a text has to be scored. `coefficients` is (word,
    coefficient), best a written table. Rows are placed by key before their words are spread
    out, so counting, and with a small coefficient table also ranking per row, needs
    no further shuffle.
    """
    return _counted(df, key, tokens).join(broadcast_if_small(coefficients), "word").select(
        key, "word", (F.col("n") * F.col("coefficient")).alias("weight")
    )


def _counted(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, word, n). The texts are placed, not their word lists, which take up more.

    Parts are of so many rows, so that counting and ranking a part's words stays in memory, however large the table.
    """
    parts = max(-(-df.count() // PART_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    placed = df.repartition(parts, key).select(key, tokens.alias("_words"))
    return items(placed, [key], F.col("_words"), "word").groupBy(key, "word").agg(F.count("*").alias("n"))


def _frequent(coefficients: DataFrame) -> DataFrame:
    """The words of the most rows, as many as a broadcast may hold: quarter powers of two of rows, from the top."""
    level = F.floor(F.log2("rows") * 4)
    coefficients = coefficients.where(F.length("word") <= SMALL_CHARS // SMALL_ROWS)
    sizes = coefficients.groupBy(level.alias("level")).count().collect()
    least, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        held += r["count"]
        if held > SMALL_ROWS:
            break
        least = r["level"]
    return coefficients.where(F.lit(False) if least is None else level >= least)


def top_linear_words(
    df: DataFrame, coefficients: DataFrame, key: str, tokens: Column, digits: int, n: int = fixed.TOP_WORDS
) -> DataFrame:
    """`top_words` of `linear_word_weights`, with weights rounded to `digits`.

    `coefficients` is a written table (word, coefficient, rows), `rows` being how many rows a word is in. Most words
    of a text are frequent ones: these meet a broadcast table, and of them only a text's heaviest go on. Only words that are not
    in it meet the rest of the table in a join that shuffles. They are written in between.
    """
    if is_small(coefficients):
        frequent, rare = coefficients, None
    else:
        frequent = _frequent(coefficients)
        rare = coefficients.join(F.broadcast(frequent.select("word")), "word", "left_anti")
    weight = F.round(F.col("n") * F.col("coefficient"), digits)
    known = F.broadcast(frequent.select("word", "coefficient"))
    found = _counted(df, key, tokens).join(known, "word", "inner" if rare is None else "left")
    found = found.select(key, "word", "n", weight.alias("weight"))
    if rare is None:
        return top_words(found.drop("n"), key, n)
    place = F.row_number().over(W.partitionBy(key).orderBy(F.abs("weight").desc_nulls_last(), "word"))
    left = found.withColumn("_place", place).where(F.col("weight").isNull() | (F.col("_place") <= n))
    left = materialize(left.drop("_place"), "heaviest")
    others = left.where(F.col("weight").isNull()).drop("weight").join(rare.select("word", "coefficient"), "word")
    others = others.select(key, "word", weight.alias("weight"))
    return top_words(left.where(F.col("weight").isNotNull()).drop("n").unionByName(others), key, n)


def top_words(weights: DataFrame, key: str, n: int = fixed.TOP_WORDS) -> DataFrame:
    """The n heaviest words of each row by absolute weight, ties by word."""
    return top_rows(weights, [key], [F.abs("weight").desc(), F.col("word")], n)


def top_words_in_list(words: Column, n: int = fixed.TOP_WORDS) -> Column:
    """The same on a list of (word, weight) inside a row."""

    def heavier(a: Column, b: Column) -> Column:
        x, y = F.abs(a["weight"]), F.abs(b["weight"])
        return (
            F.when(x > y, -1)
            .when(x < y, 1)
            .when(a["word"] < b["word"], -1)
            .when(a["word"] > b["word"], 1)
            .otherwise(0)
        )

    return F.slice(F.array_sort(words, heavier), 1, n)


def _share(*parts: Column) -> Column:
    """A number in [0, 1) drawn from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def perturb(
    df: DataFrame, key: str, tokens: Column, samples: int, seed: int, target: str | None = None
) -> DataFrame:
    """Variants of each text with words left out at random.

    (key, target, sample, kept, distinct, variant): sample 0 is the whole text; `kept`
    are the places, in the list of distinct words, of the words left in. A word is kept or
    dropped with all its occurrences. The number of variants per row is fixed.
    """
    own = [key] if target is None else [key, target]
    base = df.select(*own, tokens.alias("_tokens")).withColumn(
        "distinct", F.array_distinct("_tokens")
    )
    each = base.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(samples))).alias("sample")
    )
    rate = _share(F.lit(seed), F.col(key), F.col("sample"))

    def stays(word: Column) -> Column:
        drawn = _share(F.lit(seed), F.col(key), F.col("sample"), word)
        return (F.col("sample") == 0) | (drawn < rate)

    marked = F.transform(
        F.col("distinct"), lambda w, i: F.when(stays(w), i.cast("int"))
    )
    return each.select(
        *own,
        "sample",
        F.array_compact(marked).alias("kept"),
        F.size("distinct").alias("n_words"),
        F.when(F.col("sample") == 0, F.col("distinct")).alias("distinct"),
        F.array_join(F.filter("_tokens", stays), " ").alias("variant"),
    )


def forward_selection(x: np.ndarray, y: np.ndarray, names: Sequence[str], n: int) -> list[int]:
    """Up to `n` columns, each the one that explains most of what the ones before leave of `y`.

    Columns are scaled by the roots of the row weights and centred. A candidate's gain comes from the part
    of it that is at right angles to the columns taken, which is kept up to date step by step, so no
    candidate is fitted anew. A column that the ones taken determine is never taken. Equal gains go to the smaller
    name, and so do all once nothing is left to be explained.
    """
    rest, left, taken = x.copy(), y.copy(), []
    sizes = (x**2).sum(axis=0)
    total = float(y @ y)
    while len(taken) < n:
        now = (rest**2).sum(axis=0)
        open_ = now > NOTHING * np.maximum(sizes, NOTHING)
        open_[taken] = False
        if not open_.any():
            break
        explained = (left @ rest) ** 2 if float(left @ left) > NOTHING * total else np.zeros(len(now))
        gains = np.where(open_, explained / np.where(open_, now, 1.0), -1.0)
        ties = np.flatnonzero(gains >= gains.max() * (1 - NOTHING))
        best = min(ties.tolist(), key=lambda i: names[i])
        unit = rest[:, best] / np.sqrt(now[best])
        rest = rest - np.outer(unit, unit @ rest)
        left = left - unit * (unit @ left)
        taken.append(best)
    return taken


def _ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Slopes of a ridge fit, solved in the smaller of the two spaces."""
    if x.shape[1] <= len(x):
        return np.linalg.solve(x.T @ x + penalty * np.eye(x.shape[1]), x.T @ y)
    return x.T @ np.linalg.solve(x @ x.T + penalty * np.eye(len(x)), y)


def local_weights(
    df: DataFrame,
    key: str,
    tokens: Column,
    score: Callable[[Column], Column],
    samples: int = 200,
    seed: int = fixed.SAMPLE_SEED,
    n: int = fixed.TOP_WORDS,
    target: str | None = None,
    ridge: float = RIDGE,
    selection: str = FORWARD,
) -> DataFrame:
    """(key, words): the words of a local linear model around each row, heaviest first.

    All variants are scored in batches; then each row gets a weighted
    ridge fit of its scores on its word masks. A group holds `samples` + 1 rows, however
    large the table. `score` maps the variant text to the score to explain; with `target`, a
    column holding a class id, it gives one score per class, and each row has the score of
    its own class explained. `ridge` is the penalty of the local model. Its words are found by forward selection, the way for few
    words, and fitted alone; or, by `selection`, they are the heaviest of a fit of all words.
    """
    if selection not in (FORWARD, HEAVIEST):
        raise ValueError(f"unknown selection {selection!r}")
    variants = perturb(df, key, tokens, samples, seed, target)
    explained = score(F.col("variant"))
    if target is not None:
        # scored once per variant, whatever the class
        variants = variants.withColumn("_scores", explained)
        explained = F.get("_scores", F.col(target).cast("int"))
    scored = variants.select(
        key, "sample", "kept", "n_words", "distinct", explained.alias("score")
    )
    key_type = df.schema[key].dataType.simpleString()
    width = KERNEL_WIDTH

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sample")
        names = list(group["distinct"].iloc[0])
        masks = np.zeros((len(group), len(names)))
        for row, kept in enumerate(group["kept"]):
            masks[row, np.asarray(kept, dtype=int)] = 1.0
        # distance of a mask from the whole text: cosine, in percent
        away = 100.0 * (1.0 - np.sqrt(masks.mean(axis=1))) if names else np.zeros(len(group))
        weight = np.sqrt(np.exp(-(away**2) / width**2))
        y = group["score"].to_numpy(dtype=float)
        x = masks - np.average(masks, axis=0, weights=weight) if names else masks
        target = y - np.average(y, weights=weight)
        root = np.sqrt(weight)
        xw, yw = x * root[:, None], target * root
        chosen = forward_selection(xw, yw, names, n) if selection == FORWARD else list(range(len(names)))
        slope = dict(zip(chosen, _ridge(xw[:, chosen], yw, ridge), strict=True))
        best = sorted(chosen, key=lambda i: (-abs(slope[i]), names[i]))[:n]
        return pd.DataFrame(
            {
                key: [group[key].iloc[0]],
                "words": [[{"word": names[i], "weight": float(slope[i])} for i in best]],
            }
        )

    return scored.groupBy(key).applyInPandas(
        fit, f"{key} {key_type}, words array<struct<word:string,weight:double>>"
    )


def word_rows(df: DataFrame, words: str = "words", min_len: int = 2) -> DataFrame:
    """One row per listed word of at least `min_len` characters: (…, word, weight)."""
    rest = [c for c in df.columns if c != words]
    flat = flatten(df, [words]).select(*rest, f"{words}.word", f"{words}.weight")
    return flat.fillna("", subset=["word"]).where(F.length("word") >= min_len)


def best_word_rows(df: DataFrame, words: str = "words", min_len: int = 2) -> DataFrame:
    """The heaviest row per word."""
    return best_words(word_rows(df, words, min_len), "word", "weight")
