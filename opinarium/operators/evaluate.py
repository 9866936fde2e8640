"""Model quality from prediction rows (id, label, pred, scores).

Everything starts from counts per (label, pred), which combine before the shuffle;
what follows works on one row per pair of classes.

A failed prediction is NULL. It counts as wrong, in accuracy and in the recall of its true class;
it is no class of its own, adds nothing to what a class was predicted for, and stands in the
matrix in a cell with NULL for the prediction. Rows without a truth are left out everywhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions.labels import argmax
from opinarium.operators.frames import items
from opinarium.operators.indexing import with_row_index


def _right(label: str, pred: str) -> Column:
    """Whether a row is right: NULL without a truth, false without a prediction."""
    told = F.when(F.col(pred).isNull(), F.lit(False)).otherwise(F.col(label) == F.col(pred))
    return F.when(F.col(label).isNotNull(), told)


def accuracy(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.agg(F.avg(_right(label, pred).cast("int")).alias("accuracy"))


def class_count(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of distinct labels."""
    return df.agg(F.count_distinct(label).alias("classes"))


def label_width(df: DataFrame, label: str) -> DataFrame:
    """Width of multi-hot labels, and whether all rows agree on it."""
    return df.agg(
        F.max(F.size(label)).alias("classes"),
        (F.max(F.size(label)) == F.min(F.size(label))).alias("same_width"),
    )


def pair_counts(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """(label, pred, n): the filled cells of the confusion matrix, its sparse form."""
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"), F.col(pred).alias("pred"))
        .agg(F.count("*").alias("n"))
    )


def _class_counts(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True positives, support and predictions per class of truth or prediction."""
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.when(_right("label", "pred"), F.col("n")).otherwise(zero).alias("tp"),
            F.col("n").alias("support"),
            zero.alias("predicted"),
        ),
        F.struct(
            F.col("pred").alias("class"),
            zero.alias("tp"),
            zero.alias("support"),
            F.col("n").alias("predicted"),
        ),
    )
    return (
        pairs.select(*by, F.explode(sides).alias("s"))
        .select(*by, "s.*")
        .where("class is not null")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def _scored(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from tp, support and predicted; 0 where undefined."""
    return counts.withColumns(
        {
            "precision": _ratio(F.col("tp"), F.col("predicted")),
            "recall": _ratio(F.col("tp"), F.col("support")),
            "f1": _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")),
        }
    )


SCORES = ("precision", "recall", "f1")


def _averages(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Macro, weighted and micro averages of per-class rows."""
    total = F.sum("support")
    macro = [F.avg(c).alias(c) for c in SCORES]
    weighted = [_ratio(F.sum(F.col(c) * F.col("support")), total).alias(c) for c in SCORES]
    hit, said = F.sum("tp"), F.sum("predicted")
    micro = [
        _ratio(hit, said).alias("precision"),
        _ratio(hit, total).alias("recall"),
        _ratio(2 * hit, total + said).alias("f1"),
    ]
    kinds = {"macro avg": macro, "weighted avg": weighted, "micro avg": micro}
    summed = rows.groupBy(*by).agg(
        total.alias("support"), *[F.struct(*cols).alias(k) for k, cols in kinds.items()]
    )
    lines = F.array(
        *[F.struct(F.lit(k).alias("class"), F.col(f"`{k}`").alias("m")) for k in kinds]
    )
    return summed.select(*by, "support", F.explode(lines).alias("line")).select(
        *by, "line.class", "line.m.*", "support"
    )


def class_report(
    df: DataFrame,
    label: str = "label",
    pred: str = "pred",
    names: Mapping[int, str] | None = None,
    digits: int = 4,
) -> DataFrame:
    """(class, precision, recall, f1, support): a row per class, then the averages.

    Classes are those of truth or prediction. For single labels the micro recall
    is the accuracy. `names` renames classes by id.
    """
    rows = _scored(_class_counts(pair_counts(df, label, pred)))
    shown = F.col("class").cast("string")
    if names:
        listed = F.create_map(*[F.lit(x) for kv in names.items() for x in (str(kv[0]), kv[1])])
        shown = F.coalesce(F.try_element_at(listed, shown), shown)
    columns = [*[F.col(c) for c in SCORES], F.col("support")]
    report = rows.select(shown.alias("class"), *columns).unionByName(_averages(rows))
    return report.select("class", *[F.round(c, digits).alias(c) for c in SCORES], "support")


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """(label, pred, n) with zero cells, over all classes of truth or prediction.

    The list of classes comes from the filled cells; zero cells are spread out from it and
    summed with the filled ones. `pair_counts` is the sparse form, without zero cells.
    """
    pairs = pair_counts(df, label, pred)
    classes = (
        pairs.select(F.explode(F.array("label", "pred")).alias("class"))
        .where("class is not null")
        .agg(F.array_sort(F.collect_set("class")).alias("classes"))
    )
    rows = classes.select("classes", F.explode("classes").alias("label"))
    zero = rows.select("label", F.explode("classes").alias("pred"), F.lit(0).cast("long").alias("n"))
    return pairs.unionByName(zero).groupBy("label", "pred").agg(F.sum("n").alias("n"))


def confusion_wide(
    df: DataFrame, classes: Sequence, label: str = "label", pred: str = "pred"
) -> DataFrame:
    """Confusion matrix with one column per given class; failed predictions have none."""
    wide = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).pivot(pred, list(classes)).count()
    return wide.fillna(0)


def mean_loss(df: DataFrame, loss: Column, name: str = "loss") -> DataFrame:
    return df.agg(F.avg(loss).alias(name))


def two_target_loss(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """Both mean losses and their mean."""
    return df.agg(F.avg(first).alias("loss1"), F.avg(second).alias("loss2")).withColumn(
        "loss", (F.col("loss1") + F.col("loss2")) / 2
    )


def batch_means(
    df: DataFrame, order: Sequence[str], batch_size: int, metrics: Mapping[str, Column]
) -> DataFrame:
    """Mean of per-batch means: a short last batch counts as much as a full one."""
    rows = df.select(*order, *[c.alias(n) for n, c in metrics.items()])
    indexed = with_row_index(rows, order, "_index")
    batches = indexed.groupBy(F.floor(F.col("_index") / batch_size).alias("_batch")).agg(
        *[F.avg(n).alias(n) for n in metrics]
    )
    return batches.agg(
        F.count("*").alias("batches"), *[F.avg(n).alias(n) for n in metrics]
    )


def first_maximum(df: DataFrame, truth: str, scores: str) -> DataFrame:
    """Multi-hot truth and scores reduced to one class each."""
    return df.withColumns({"label": argmax(F.col(truth)), "pred": argmax(F.col(scores))})


def _told(truth: str, predicted: str) -> Column:
    """The predicted cells, all 0 for a failed prediction."""
    return F.coalesce(
        F.col(predicted).cast("array<bigint>"),
        F.transform(F.col(truth), lambda y: F.lit(0).cast("long")),
    )


def _cells(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    pairs = F.arrays_zip(F.col(truth).alias("y"), _told(truth, predicted).alias("p"))
    return items(df, [], pairs, "c", "position").select(
        "position",
        F.col("c.y").cast("long").alias("y"),
        F.col("c.p").cast("long").alias("p"),
    )


def cell_accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Share of equal cells over all cells, and the mean over rows of their share.

    No cell of a failed prediction is equal.
    """
    equal = F.aggregate(
        F.zip_with(truth, predicted, lambda a, b: (a.cast("int") == b.cast("int")).cast("int")),
        F.lit(0),
        lambda a, b: a + b,
    )
    equal = F.when(F.col(truth).isNotNull(), F.coalesce(equal, F.lit(0)))
    return df.agg(
        (F.sum(equal) / F.sum(F.size(truth))).alias("cell_accuracy"),
        F.avg(equal / F.size(truth)).alias("row_accuracy"),
    )


def multi_label_report(
    df: DataFrame, truth: str, predicted: str, digits: int = 4
) -> DataFrame:
    """(class, precision, recall, f1, support) per position, then all averages.

    The samples average is the mean over rows of the row's own scores.
    """
    rows = _scored(
        _cells(df, truth, predicted)
        .groupBy(F.col("position").alias("class"))
        .agg(
            F.sum(F.col("y") * F.col("p")).alias("tp"),
            F.sum("y").alias("support"),
            F.sum("p").alias("predicted"),
        )
    )

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)

    y = F.col(truth).cast("array<bigint>")
    p = _told(truth, predicted)
    samples = (
        _scored(
            df.select(
                total(F.zip_with(y, p, lambda a, b: a * b)).alias("tp"),
                total(y).alias("support"),
                total(p).alias("predicted"),
            )
        )
        .agg(*[F.avg(c).alias(c) for c in SCORES], F.sum("support").alias("support"))
        .withColumn("class", F.lit("samples avg"))
    )
    report = (
        rows.select(F.col("class").cast("string"), *SCORES, "support")
        .unionByName(_averages(rows))
        .unionByName(samples)
    )
    return report.select("class", *[F.round(c, digits).alias(c) for c in SCORES], "support")


def history_rows(df: DataFrame, run: Column, epoch: Column, metrics: Sequence[str]) -> DataFrame:
    """Wide metric columns as (run, epoch, metric, value) rows."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    )
    return df.select(run.alias("run"), epoch.alias("epoch"), F.explode(entries).alias("e")).select(
        "run", "epoch", "e.*"
    )
