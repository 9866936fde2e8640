"""Word-count features and weights for training."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, HashingTF, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions.text import words
from opinarium.operators.frames import items

def word_bag(text: Column) -> Column:
    """Lower-case words without punctuation."""
    return words(F.lower(text))


def vocabulary(train: DataFrame, tokens: str) -> DataFrame:
    """(word): the words of the training rows, however many."""
    return items(train, [], F.col(tokens), "word").distinct()


def word_counts(
    df: DataFrame, key: str, tokens: str, known: DataFrame, binary: bool = False
) -> DataFrame:
    """(key, word, value): counts, or presence, of the known words in each row.

    The sparse form of a count vector, for a vocabulary of any size: counts meet the table of known
    words in a join. Repeated keys are counted together.
    """
    counted = items(df, [key], F.col(tokens), "word").groupBy(key, "word").agg(F.count("*").alias("n"))
    value = F.lit(1.0) if binary else F.col("n").cast("double")
    return counted.join(known.select("word"), "word").select(key, "word", value.alias("value"))


def fit_word_counts(
    train: DataFrame, tokens: str, output: str, size: int, binary: bool = False
) -> CountVectorizerModel:
    """Count (or presence) vectors for a classifier, fitted on the training rows only.

    A vector needs a width: `size` words at most, the most frequent ones, as the caller decides.
    """
    return CountVectorizer(
        inputCol=tokens, outputCol=output, binary=binary, vocabSize=size
    ).fit(train)


def hashed_counts(tokens: str, output: str, size: int) -> HashingTF:
    """Count vectors of a given width that leave no word out: words share places by hash."""
    return HashingTF(inputCol=tokens, outputCol=output, numFeatures=size)


def with_probabilities(
    df: DataFrame, probabilities: DataFrame, key: str, features: str, output: str
) -> DataFrame:
    """Append another model's class probabilities to a feature vector, matched by row id.

    The id must be unique among the probabilities: a second row for one id raises.
    """
    once = probabilities.groupBy(key).agg(
        F.count("*").alias("_n"), F.first("probability").alias("probability")
    )
    checked = once.select(
        key,
        F.when(F.col("_n") == 1, F.col("probability"))
        .otherwise(F.raise_error(F.lit("two probability rows have one id")))
        .alias("probability"),
    )
    joined = df.join(checked, key)
    assembler = VectorAssembler(inputCols=[features, "probability"], outputCol=output)
    return assembler.transform(joined).drop("probability")


def entries(vector: Column) -> Column:
    """(index, value) of the stored numbers of a vector, dense or sparse: a wide sparse one is never spread out."""
    raw = F.unwrap_udt(vector)
    numbers = F.transform(raw["values"], lambda x, i: i)
    places = F.when(raw["type"] == 0, raw["indices"]).otherwise(numbers)
    return F.arrays_zip(places.alias("index"), raw["values"].alias("value"))


def width(vector: Column) -> Column:
    """The length of a vector."""
    raw = F.unwrap_udt(vector)
    return F.coalesce(raw["size"], F.size(raw["values"]))


def error_weight(prediction: Column, label: Column, wrong: float = 10.0) -> Column:
    """Weight of a row for the next model: more when the first model is wrong."""
    return F.when(prediction != label, wrong).otherwise(1.0)
