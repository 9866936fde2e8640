"""Linear models over words without a vector: any number of words, fitted by sums over tables.

Rows are cells (key, word, value); the model is a table (word, w), one weight per class, and an intercept per
class. All classes, labels or targets are fitted in the same pass. For a fit, words are numbered from the most
frequent on and the cells listed by row once. A step reads these lists: scores of a row, its residual and the sums of
residuals by word come from one scan, in which no cell is joined or moved, against arrays of the weights of the front words.
`NUMBERS` bounds the arrays, and with them what the driver holds; the cells of rarer words meet their weights in joins by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.functions.labels import argmax, sigmoid, softmax
from opinarium.operators.indexing import with_row_index
from opinarium.runtime import SMALL_ROWS, broadcast_if_small, materialize, new_folder, run_folder

NUMBERS = 1 << 22  # words times classes of an array: so many weights, and so many slopes, are on the driver and in a worker
WORDS = 1 << 14  # in a record of sums
ROWS = 1024  # computed at a time
SUMS = "chunk int, ids binary, sums binary, state binary"
TOUCHED, KNOWN = 1, 2  # a word has rows; one of them has a residual of the class

# The gradient of a row's loss by its scores, over the other columns of the row.
Residual = Callable[[Column], Column]


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def one_of(target: Column) -> Residual:
    """Cross-entropy of softmax against a distribution over the classes."""
    return lambda scores: minus(softmax(scores), target)


def each_of(target: Column) -> Residual:
    """Binary cross-entropy of every position against a multi-hot label."""
    return lambda scores: minus(sigmoid(scores), target)


def side_by_side(targets: list[Column], classes: int) -> Residual:
    """Several targets of as many classes each, their scores one behind the other."""

    def residual(scores: Column) -> Column:
        parts = [F.slice(scores, i * classes + 1, classes) for i in range(len(targets))]
        return F.concat(*[one_of(t)(p) for t, p in zip(targets, parts, strict=True)])

    return residual


def taught(teacher: Column, target: Column, alpha: float, temperature: float) -> Residual:
    """Soft cross-entropy at a temperature against a teacher's scores, and hard against the truth.

    The loss is alpha * T^2 * soft + (1 - alpha) * hard, so the gradient of the soft part is
    alpha * T * (softmax(s / T) - softmax(t / T)): it does not fade as T grows.
    """

    def cooled(scores: Column) -> Column:
        return softmax(F.transform(scores, lambda x: x / temperature))

    def residual(scores: Column) -> Column:
        soft = minus(cooled(scores), cooled(teacher))
        hard = minus(softmax(scores), target)
        return F.zip_with(soft, hard, lambda a, b: alpha * temperature * a + (1.0 - alpha) * b)

    return residual


def unit_cells(rows: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, word, value): word counts scaled to length one per row. Keys must be unique."""
    # dealt by key once, neither the counts nor the lengths move the cells again
    dealt = rows.where(F.col(key).isNotNull()).select(key, tokens).repartition(key)
    counted = dealt.select(key, F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull())
    counted = counted.groupBy(key, "word").agg(F.count("*").cast("double").alias("value"))
    listed = counted.groupBy(key).agg(
        F.collect_list(F.struct("word", "value")).alias("_c"), F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("_length")
    )
    apart = listed.select(key, "_length", F.explode("_c").alias("_c"))
    return apart.select(key, "_c.word", (F.col("_c.value") / F.col("_length")).alias("value"))


@dataclass
class Linear:
    """A fitted model: weights (word, w) as a written table, an intercept per class, the largest slope per step."""

    weights: DataFrame
    bias: list[float]
    slopes: list[float] = field(default_factory=list)


def _sums(column: Column, times: Column, classes: int) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(k)) * times) for k in range(classes)])


def _scores(rows: DataFrame, cells: DataFrame, key: str, weights: DataFrame, bias: list[float]) -> DataFrame:
    """The rows with `scores`. Words the model does not know count nothing."""
    joined = cells.join(weights.select("word", "w"), "word")
    summed = joined.groupBy(key).agg(_sums(F.col("w"), F.col("value"), len(bias)).alias("_sums"))
    start = F.array(*[F.lit(float(b)) for b in bias])
    added = F.zip_with(F.coalesce("_sums", F.transform(start, lambda b: b * 0.0)), start, lambda a, b: a + b)
    return rows.join(summed, key, "left").withColumn("scores", added).drop("_sums")


def scored(rows: DataFrame, cells: DataFrame | Packed, key: str, model: Linear) -> DataFrame:
    """The rows with a column `scores`, one per class."""
    if not isinstance(cells, Packed):
        return _scores(rows, cells, key, model.weights, model.bias)
    listed, front = rows.join(cells.lists, key, "left"), _shared(rows, _front_weights(cells, model))
    return _listed_scores(listed, cells, key, front, model.weights, model.bias).drop(*LISTS)


def _gradient(residuals: DataFrame, cells: DataFrame, key: str, classes: int) -> DataFrame:
    """(word, d): the residuals of a word's rows, summed by its values."""
    joined = cells.join(residuals.select(key, "_r"), key)
    return joined.groupBy("word").agg(_sums(F.col("_r"), F.col("value"), classes).alias("d"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


# --- cells listed by row


@dataclass
class Packed:
    """Cells by row, written once for any number of fits.

    `names` (word, number, docs) has all words, the most frequent first. `lists` (key, _ids, _values) has the `front` first of
    them, as packed numbers by key, and `rest` (key, word, value) the cells of the others, None where there are none.
    """

    names: DataFrame
    lists: DataFrame
    rest: DataFrame | None
    front: int


LISTS = ("_ids", "_values")


def packed(cells: DataFrame, key: str, classes: int) -> Packed:
    """The cells for fits of so many classes. Pass written ones."""
    cells = cells.where(F.col("word").isNotNull())
    sizes = materialize(cells.groupBy("word").agg(F.count("*").alias("docs")), "words")
    names = with_row_index(sizes, [F.desc("docs"), "word"], "number").select("word", "number", "docs")
    total = names.count()
    front = min(total, NUMBERS // classes)
    known = names.where(F.col("number") < front).select("word", F.col("number").cast("int").alias("_id"))
    # most cells are of few words, which meet a broadcast table; the others are shuffled by word
    often = broadcast_if_small(known.where(F.col("_id") < SMALL_ROWS))
    numbered = cells.join(often, "word")
    if front > SMALL_ROWS:
        seldom = cells.join(often, "word", "left_anti").join(known.where(F.col("_id") >= SMALL_ROWS), "word")
        numbered = numbered.unionByName(seldom)
    value = F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")
    lists = numbered.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_id", value))).alias("_c"))
    flat = F.arrow_udf(_as_bytes, "binary")
    lists = lists.select(key, flat(F.col("_c._id")).alias("_ids"), flat(F.col("_c.value")).alias("_values"))
    rest = None
    if front < total:
        rest = materialize(cells.join(names.where(F.col("number") >= front).select("word"), "word"), "rest-cells")
    return Packed(names, materialize(lists, "lists"), rest, front)


def _as_bytes(lists: pa.Array) -> pa.Array:
    flat = lists.flatten().to_numpy()
    ends = np.cumsum(np.concatenate([[0], lists.value_lengths().to_numpy()])) * flat.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(lists), buffers)


def _numbers(packs: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows behind each other, and how many each row has. None in rows that are NULL."""
    if not len(packs):
        return np.empty(0, kind), np.zeros(0, np.int64)
    _, ends, data = packs.buffers()
    ends = np.frombuffer(ends, np.int32)[packs.offset : packs.offset + len(packs) + 1]
    lengths = np.diff(ends).astype(np.int64) // np.dtype(kind).itemsize
    count = int(lengths.sum())
    return np.frombuffer(data, kind, count, int(ends[0])) if count else np.empty(0, kind), lengths


def _matrix(lists: pa.Array, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, rows) of numbers, zero where there is none, and where there is one."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    kept = (place < classes) & flat.is_valid().to_numpy(zero_copy_only=False)
    numbers, known = np.zeros((classes, len(lists))), np.zeros((classes, len(lists)), bool)
    numbers[place[kept], row[kept]] = flat.fill_null(0.0).to_numpy(zero_copy_only=False)[kept]
    known[place[kept], row[kept]] = True
    return numbers, known


def _shared(rows: DataFrame, value: object) -> Broadcast:
    return rows.sparkSession.sparkContext.broadcast(value)


def _listed_scores(
    rows: DataFrame, cells: Packed, key: str, front: Broadcast, weights: DataFrame | None, bias: list[float]
) -> DataFrame:
    """Rows with lists, with `scores` from weights of the front words and a table of those of others."""
    classes = len(bias)

    def score(ids: pa.Array, values: pa.Array) -> pa.Array:
        w, parts = front.value, []
        for at in range(0, len(ids), ROWS):
            numbers, lengths = _numbers(ids.slice(at, ROWS), np.int32)
            times, _ = _numbers(values.slice(at, ROWS), np.float64)
            numbers, filled = numbers.astype(np.int64), lengths > 0
            starts = (np.cumsum(lengths) - lengths)[filled]
            scores = np.tile(np.array(bias), (len(lengths), 1))
            for k in range(classes if len(starts) else 0):
                scores[filled, k] += np.add.reduceat(w[k].take(numbers) * times, starts)
            parts.append(scores)
        flat = np.concatenate(parts).ravel() if parts else np.empty(0)
        return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, classes, dtype=np.int32), flat)

    rows = rows.withColumn("scores", F.arrow_udf(score, "array<double>")(*LISTS))
    if cells.rest is None:
        return rows
    # lists are not moved to the sums
    joined = cells.rest.join(weights.select("word", "w"), "word")
    summed = joined.groupBy(key).agg(_sums(F.col("w"), F.col("value"), classes).alias("_rest"))
    both = F.zip_with("scores", "_rest", lambda a, b: a + F.coalesce(b, F.lit(0.0)))
    rows = rows.drop(*LISTS).join(summed, key, "left")
    return rows.withColumn("scores", F.when(F.col("_rest").isNull(), F.col("scores")).otherwise(both)).drop("_rest")


def _records(sums: np.ndarray, state: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Arrays (classes, words) as records of the words that are touched."""
    for chunk, at in enumerate(range(0, sums.shape[1], WORDS)):
        s, k = sums[:, at : at + WORDS], state[:, at : at + WORDS]
        ids = np.flatnonzero(k.any(axis=0)).astype(np.int32)
        if len(ids):
            yield _record(chunk, ids, s[:, ids], k[:, ids])


def _record(chunk: int, ids: np.ndarray, sums: np.ndarray, state: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([chunk], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, sums, state))]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "ids", "sums", "state"])


def _merged(records: pa.Table, classes: int) -> pa.Table:
    """The records of one chunk added up."""
    sums, state = np.zeros((classes, WORDS)), np.zeros((classes, WORDS), np.uint8)
    for batch in records.to_batches():
        for i in range(batch.num_rows):
            ids, s, k = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((1, "i4"), (2, "f8"), (3, "u1")))
            sums[:, ids] += s.reshape(classes, -1)
            state[:, ids] |= k.reshape(classes, -1)
    return pa.Table.from_batches(list(_records(sums, state))).set_column(0, "chunk", records["chunk"].slice(0, 1))


def _gathered(records: DataFrame, classes: int, front: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and state (classes, front) of all tasks, and the sums of chunk -1."""

    def merge(table: pa.Table) -> pa.Table:
        return _merged(table, classes)

    sums, state, there = np.zeros((classes, front)), np.zeros((classes, front), np.uint8), np.zeros(classes)
    for r in records.groupBy("chunk").applyInArrow(merge, SUMS).toLocalIterator():
        s = np.frombuffer(r["sums"]).reshape(classes, -1)
        if r["chunk"] < 0:
            there = s[:, 0].copy()
            continue
        ids = np.frombuffer(r["ids"], np.int32) + r["chunk"] * WORDS
        sums[:, ids] = s
        state[:, ids] = np.frombuffer(r["state"], np.uint8).reshape(classes, -1)
    return sums, state, there


def _listed_gradient(rows: DataFrame, classes: int, front: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The residuals `_r` of each front word's rows, summed by its values, what is known of it, and the sums over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, state, there = np.zeros((classes, front)), np.zeros((classes, front), np.uint8), np.zeros(classes)
        whole = np.zeros(front, bool)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids, values, residuals = batch.slice(at, ROWS).columns
                numbers, lengths = _numbers(ids, np.int32)
                times, _ = _numbers(values, np.float64)
                numbers, (r, known) = numbers.astype(np.int64), _matrix(residuals, classes)
                for k in range(classes):
                    np.add.at(sums[k], numbers, times * np.repeat(r[k], lengths))
                there += r.sum(axis=1)
                if known.all():
                    whole[numbers] = True
                    continue
                for k in range(classes):
                    state[k][numbers] |= TOUCHED
                    state[k][numbers[np.repeat(known[k], lengths)]] |= KNOWN
        state[:, whole] |= TOUCHED | KNOWN
        yield from _records(sums, state)
        yield _record(-1, np.zeros(1, np.int32), there, np.full(classes, TOUCHED, np.uint8))

    return _gathered(rows.select(*LISTS, "_r").mapInArrow(run, SUMS), classes, front)


def _front_weights(cells: Packed, model: Linear) -> np.ndarray:
    """A model's weights of the front words, zero where it has none."""
    classes, front = len(model.bias), cells.front

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, state = np.zeros((classes, front)), np.zeros((classes, front), np.uint8)
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            sums[:, numbers], state[:, numbers] = _matrix(batch.column(1), classes)[0], TOUCHED
        yield from _records(sums, state)

    named = cells.names.where(F.col("number") < front).join(model.weights, "word").select("number", "w")
    return _gathered(named.mapInArrow(run, SUMS), classes, front)[0]


def _by_word(cells: Packed, numbers: np.ndarray, state: np.ndarray, name: str) -> DataFrame:
    """(word, docs, name): the numbers of the touched front words, NULL for a class where nothing is known."""
    shared = _shared(cells.names, (numbers, state))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, state = shared.value
        classes = len(numbers)
        for batch in batches:
            batch = batch.filter(pa.array((state[:, batch["number"].to_numpy()] > 0).any(axis=0)))
            at = batch["number"].to_numpy()
            known = (state[:, at] & KNOWN).T.ravel() > 0
            flat = pa.array(numbers[:, at].T.ravel(), mask=~known)
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, classes, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([batch["word"], batch["docs"], lists], ["word", "docs", name])

    front = cells.names.where(F.col("number") < cells.front)
    return front.mapInArrow(run, f"word string, docs long, {name} array<double>")


def _packed_gradient(
    rows: DataFrame, cells: Packed, key: str, residual: Residual, front: np.ndarray, weights: DataFrame | None, bias: list[float]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame | None]:
    """The residuals at a model summed by front word, what is known of it, their sums, and (word, d) of the other words.

    Takes rows with their lists. Where there are other words, residuals are written.
    """
    classes, shared = len(bias), _shared(rows, front)
    found = _listed_scores(rows, cells, key, shared, weights, bias)
    if cells.rest is None:
        sums = _listed_gradient(found.withColumn("_r", residual(F.col("scores"))), classes, cells.front)
        shared.destroy()
        return *sums, None
    residuals = materialize(found.select(key, residual(F.col("scores")).alias("_r")), "residuals")
    sums = [F.coalesce(F.sum(F.get("_r", F.lit(k))), F.lit(0.0)) for k in range(classes)]
    total, *there = residuals.agg(F.count("*"), *sums).first()
    shared.destroy()
    small = F.broadcast(residuals) if total * classes <= NUMBERS else residuals
    by_front, state, _ = _listed_gradient(cells.lists.join(small, key), classes, cells.front)
    return by_front, state, np.array(there), _gradient(residuals, cells.rest, key, classes)


def fit(
    rows: DataFrame,
    cells: DataFrame | Packed,
    key: str,
    residual: Residual,
    classes: int,
    penalty: float,
    steps: int = 100,
    tolerance: float = 1e-6,
) -> Linear:
    """Minimise mean loss + penalty / 2 * |w|^2; intercepts are free of the penalty.

    Gradient steps whose length is that of the last step in the curvature it met (Barzilai and
    Borwein), until no slope exceeds `tolerance`. Lineage does not grow: front words are arrays here, and the weights of others are
    written by each step. Pass written `rows` and `cells`, packed where several fits share them; keys must be unique in `rows`.
    """
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, "linear")
    total = max(rows.count(), 1)
    zeros = F.array_repeat(F.lit(0.0), F.lit(classes))
    bias, last_bias, last_slope = np.zeros(classes), np.zeros(classes), np.zeros(classes)
    slopes = []
    with run_folder(spark, "linear-steps"):
        own = cells if isinstance(cells, Packed) else packed(cells, key, classes)
        listed = materialize(rows.join(own.lists, key, "left"), "listed")
        w, g, now, weights = np.zeros((classes, own.front)), np.zeros((classes, own.front)), None, None
        if own.rest is not None:
            weights = own.rest.select("word").distinct().select("word", zeros.alias("w"), zeros.alias("_g"))
            weights = materialize(weights, "weights")
        length = 0.0
        for step in range(steps):
            if own.rest is not None:
                moved = F.zip_with("w", "_g", lambda w, g: w - g * length)
                now = weights.select("word", moved.alias("w"), F.col("w").alias("_w"), F.col("_g").alias("_h"))
            # few arrays at once: the way is the last slope times the length
            last_g, w = g, w - g * length
            g, state, there, others = _packed_gradient(listed, own, key, residual, w, now, bias.tolist())
            g /= total
            g += w * penalty
            bias_slope = there / total
            way2, bend = length**2 * float(np.vdot(last_g, last_g)), -length * float(np.vdot(last_g, g - last_g))
            steepest = max(float(g.max(initial=0.0)), -float(g.min(initial=0.0)))
            if own.rest is not None:
                slope = F.zip_with("d", "w", lambda d, w: d / total + w * penalty)
                weights = materialize(now.join(others, "word").withColumn("_g", slope).drop("d"), "weights")
                way, turn = minus(F.col("w"), F.col("_w")), minus(F.col("_g"), F.col("_h"))
                largest = F.array_max(F.transform("_g", F.abs))
                sums = weights.agg(F.sum(_dot(way, way)), F.sum(_dot(way, turn)), F.max(largest)).first()
                way2, bend, steepest = way2 + (sums[0] or 0.0), bend + (sums[1] or 0.0), max(steepest, sums[2] or 0.0)
            slopes.append(max(steepest, *map(abs, bias_slope.tolist())))
            if slopes[-1] <= tolerance:
                break
            if step:
                way2 += float(((bias - last_bias) ** 2).sum())
                bend += float(((bias - last_bias) * (bias_slope - last_slope)).sum())
                length = way2 / bend if bend > 0 else length
            else:
                length = 1.0
            last_bias, last_slope, bias = bias, bias_slope, bias - length * bias_slope
        else:
            # the last step was taken for the intercepts only
            bias = last_bias
        # words without a residual have no weight
        found = _by_word(own, w, state if step else state * KNOWN, "w").select("word", "w")
        if own.rest is not None:
            found = found.unionByName(weights.select("word", "w"))
        found.write.parquet(path)
    written = spark.read.schema("word string, w array<double>").parquet(path)
    return Linear(written, bias.tolist(), slopes)


def train_epochs(
    rows: DataFrame,
    cells: DataFrame,
    key: str,
    residual: Residual,
    loss: Residual,
    classes: int,
    epochs: int,
    rate: float,
    batches: int = 4,
    batch: Column | None = None,
    penalty: float = 0.0,
) -> tuple[DataFrame, list[Linear]]:
    """A fit over epochs of batches, with a snapshot of the model and its figures after each epoch.

    Gives (epoch, train_loss, valid_loss, valid_accuracy), computed from the scores that each snapshot gives the rows
    (key, label, held_out), and the snapshots. Rows that are held out are scored only. `batch` numbers a row's batch from 0; by
    default it comes from a hash of the key, so an epoch is the same whichever tasks run it. A step is `rate`
    against the mean gradient of its batch. Pass written `rows` and `cells`.
    """
    number = F.pmod(F.xxhash64(key), F.lit(batches)) if batch is None else batch
    dealt = rows.withColumn("_batch", F.when(~F.col("held_out"), number))
    sizes = {r["_batch"]: r["count"] for r in dealt.groupBy("_batch").count().collect()}
    zeros = F.array_repeat(F.lit(0.0), F.lit(classes))
    weights = materialize(cells.select("word").distinct().withColumn("w", zeros), "weights")
    bias, snapshots, lines = [0.0] * classes, [], []
    for epoch in range(1, epochs + 1):
        for b in sorted(n for n in sizes if n is not None):
            own = _scores(dealt.where(F.col("_batch") == b), cells, key, weights, bias)
            residuals = materialize(own.select(key, residual(F.col("scores")).alias("_r")), "residuals")
            slope = weights.join(_gradient(residuals, cells, key, classes), "word", "left")
            mean = F.transform(F.coalesce("d", zeros), lambda d: d / sizes[b])
            moved = F.zip_with("w", mean, lambda w, d: w - (d + w * penalty) * rate)
            weights = materialize(slope.select("word", moved.alias("w")), "weights")
            there = residuals.agg(*[F.sum(F.get("_r", F.lit(k))) for k in range(classes)]).first()
            bias = [x - rate * float(s) / sizes[b] for x, s in zip(bias, there, strict=True)]
        snapshots.append(Linear(weights, bias))
        judged = materialize(_scores(rows, cells, key, weights, bias), "epoch-scores")
        held, value = F.col("held_out"), loss(F.col("scores"))
        right = (argmax(F.col("scores")) == F.col("label")).cast("int")
        lines.append(
            judged.agg(
                F.avg(F.when(~held, value)).alias("train_loss"),
                F.avg(F.when(held, value)).alias("valid_loss"),
                F.avg(F.when(held, right)).alias("valid_accuracy"),
            ).withColumn("epoch", F.lit(epoch))
        )
    history = reduce(DataFrame.unionByName, lines)
    return history.select("epoch", "train_loss", "valid_loss", "valid_accuracy"), snapshots


def slopes_at(
    rows: DataFrame, cells: DataFrame | Packed, key: str, residual: Residual, model: Linear, penalty: float
) -> DataFrame:
    """(word, docs, slopes): the slope of the whole loss, not its mean, by each weight.

    From the scores of the model as written; all zero at its optimum. A row with NULL word is for the
    intercepts.
    """
    spark, path, classes = rows.sparkSession, new_folder(rows.sparkSession, "slopes"), len(model.bias)
    total = rows.count()
    with run_folder(spark, "slopes-at"):
        own = cells if isinstance(cells, Packed) else packed(cells, key, classes)
        listed = rows.join(own.lists, key, "left")
        front = _front_weights(own, model)
        d, state, there, others = _packed_gradient(listed, own, key, residual, front, model.weights, model.bias)
        by_word = _by_word(own, d, state, "d")
        if others is not None:
            by_word = by_word.unionByName(others.join(own.names, "word").select("word", "docs", "d"))
        slopes = F.zip_with("d", "w", lambda d, w: d + w * penalty * total).alias("slopes")
        by_word = by_word.join(model.weights, "word").select("word", "docs", slopes)
        free = spark.createDataFrame([(None, total, there.tolist())], "word string, docs long, slopes array<double>")
        by_word.unionByName(free).write.parquet(path)
    return spark.read.schema("word string, docs long, slopes array<double>").parquet(path)
