"""Hard negatives by bounds along a spanning tree of anchors.

For each anchor the rows of its label with the highest inner products are its positives; for each of these, the
highest rows of other labels whose score lies in a window below the positive's are its negatives.

Anchors that lie near each other share a block of bounded size, and a block has a minimum spanning
tree. The root's scores with a chunk of candidates are exact. By Cauchy and Schwarz a child's
score differs from its parent's by at most the length of the edge times the candidate's norm, so the parent's score,
or the bounds of it, bound the child's. Only candidates whose bounds overlap a window that is still
open are scored: at first the window above the anchor's fifth best positive so far, later the windows
below the positives, each cut off at its fifth best negative so far. Equal anchors are edges of length zero.

Components become whole numbers, so scores are exact: by floating point as long as they stay below
2^53, else by long arithmetic. Scores beyond a long count as the end of its range.

Every block meets every chunk through an equi-join over lanes: a chunk is in one lane, a block in all. A task holds one
chunk, one block and the best rows of the block's anchors; the best of the lanes are merged by a ranking that
is cut before the shuffle. Chunks hold rows of all labels, so no label, vector or anchor is a hot key.

Rows without id, label or vector, and those with a NULL or non-finite component, take no part. Shorter vectors
count as filled up with zeros. An id names a row: rows of the anchor's own id are not its positives or negatives, and where
ids repeat each row takes part by itself. Ties go to the smaller id. An empty table gives an empty
result; other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opinarium.llm.common import batches_of
from opinarium.operators.indexing import with_row_index
from opinarium.runtime import materialize

SCALE = 256
CHUNK_ROWS = 2048
BLOCK_ROWS = 256
LANE_CHUNKS = 32  # at most, when there are more than a thousand lanes
PAIRS = 16  # of a block and a chunk that go to a worker at once
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # the window, in hundredths of the positive's score

EXACT = 2.0**53
LONG = (1 << 63) - 1

CHUNK = "ids binary, labels binary, kind string, width int, vectors binary"
FOUND = "block long, place int, window long, id long, score long"


def _numbers(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, vectors): components floor(scale * x), rows filled up to one width."""
    lists = batch.column(2)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(float) * scale)
    vectors = np.zeros((len(sizes), int(sizes.max(initial=1))))
    vectors[np.arange(vectors.shape[1]) < sizes[:, None]] = values
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), vectors


def _written(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> dict:
    """A chunk by ascending id; vectors in the smallest type that holds them."""
    order = np.argsort(ids, kind="stable")
    small = np.abs(vectors).max(initial=0) < 1 << 15
    kind = "<i2" if small else "<f8"
    return {
        "ids": ids[order].astype("<i8").tobytes(),
        "labels": labels[order].astype("<i8").tobytes(),
        "kind": kind,
        "width": vectors.shape[1],
        "vectors": vectors[order].astype(kind).tobytes(),
    }


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["width"])
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), vectors.astype(float)


def valid_rows(rows: DataFrame, vector: str, label: Column) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def _chunks(valid: DataFrame, scale: int) -> DataFrame:
    """Rows in chunks, as the tasks read them; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                chunk = _written(*_numbers(batch.slice(start, CHUNK_ROWS), scale))
                yield pa.RecordBatch.from_pylist([chunk], schema=SCHEMA)

    return valid.mapInArrow(run, CHUNK)


SCHEMA = pa.schema(
    [("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("width", pa.int32()), ("vectors", pa.binary())]
)


def _neighbourhood(vector: str) -> Column:
    """A key that is alike for vectors that point the same way: signs along fixed directions."""

    @F.pandas_udf("long")
    def key(vectors: pd.Series) -> pd.Series:
        directions: dict[int, np.ndarray] = {}
        out = []
        for x in vectors:
            if len(x) not in directions:
                directions[len(x)] = np.random.default_rng(0).standard_normal((16, len(x)))
            # components lie within the range of doubles, sums of them need not
            signs = directions[len(x)] @ (np.sign(x) * np.log1p(np.abs(x))) > 0
            out.append(int(signs @ (1 << np.arange(16))))
        return pd.Series(out, dtype="int64")

    return key(vector)


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length): Prim's tree; `order` lists parents first, the root has parent -1."""
    n = len(vectors)
    order, parent = np.zeros(n, np.int64), np.full(n, -1)
    nearest, away = np.full(n, -1), np.full(n, np.inf)
    left = np.ones(n, bool)
    length = np.zeros(n)
    at = 0
    for step in range(n):
        order[step], parent[at], left[at] = at, nearest[at], False
        length[at] = away[at] if step else 0.0
        distance = np.sqrt(((vectors - vectors[at]) ** 2).sum(axis=1))
        closer = left & (distance < away)
        away[closer], nearest[closer] = distance[closer], at
        if step + 1 < n:
            at = int(np.where(left, away, np.inf).argmin())
            if not left[at]:  # all distances are too long for a number
                at = int(left.argmax())
    return order, parent, length


BLOCK = f"block long, {CHUNK}, anchor_ids array<long>, parents binary, lengths binary"


def _blocks(anchors: DataFrame, scale: int) -> DataFrame:
    """A row per block: its anchors, parents first, with the tree."""

    def run(group: pa.Table) -> pa.Table:
        ids, labels, vectors = _numbers(group.combine_chunks().to_batches()[0], scale)
        order, parent, length = spanning_tree(vectors)
        step_of = np.empty(len(order), np.int64)
        step_of[order] = np.arange(len(order))
        parent = np.where(parent[order] < 0, -1, step_of[parent[order]])
        small = np.abs(vectors).max(initial=0) < 1 << 15
        row = {
            "block": group["block"][0].as_py(),
            "ids": ids[order].astype("<i8").tobytes(),
            "labels": labels[order].astype("<i8").tobytes(),
            "kind": "<i2" if small else "<f8",
            "width": vectors.shape[1],
            "vectors": vectors[order].astype("<i2" if small else "<f8").tobytes(),
            "anchor_ids": ids[order].tolist(),
            "parents": parent.astype("<i8").tobytes(),
            "lengths": length[order].astype("<f8").tobytes(),
        }
        return pa.Table.from_pylist([row], schema=BLOCK_SCHEMA)

    near = anchors.withColumn("_near", _neighbourhood("vector"))
    numbered = with_row_index(near, ["_near", "label", "vector", "vec_id"])
    numbered = numbered.withColumn("block", F.expr(f"row_index div {BLOCK_ROWS}"))
    return numbered.select("vec_id", "label", "vector", "block").groupBy("block").applyInArrow(run, BLOCK)


BLOCK_SCHEMA = pa.schema(
    [("block", pa.int64()), *SCHEMA, ("anchor_ids", pa.list_(pa.int64())), ("parents", pa.binary()), ("lengths", pa.binary())]
)


class Products:
    """Exact inner products of one anchor with the candidates of a chunk, and bounds for others."""

    SLACK = 1e-9  # relative, above the rounding of lengths and norms

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        width = max(anchors.shape[1], candidates.shape[1])
        self.anchors, self.candidates = (
            x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, candidates)
        )
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((self.candidates**2).sum(axis=1))
            most = np.sqrt((self.anchors**2).sum(axis=1)).max(initial=0) * self.norms.max(initial=0)
        self.exact = bool(most < EXACT)

    def __call__(self, i: int, which: np.ndarray | slice) -> np.ndarray:
        if self.exact:
            return (self.candidates[which] @ self.anchors[i]).astype(np.int64)
        anchor = [int(x) for x in self.anchors[i]]
        rows = ([int(x) for x in row] for row in self.candidates[which])
        sums = (sum(a * b for a, b in zip(anchor, row, strict=True)) for row in rows)
        return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], np.int64)

    def reach(self, length: float) -> np.ndarray:
        """How far the scores of two anchors at this distance can lie apart."""
        return self.norms * (length * (1 + self.SLACK)) + 1e-6


class Best:
    """The `count` best (score, id) of one anchor and window so far: scores descending, ids ascending."""

    def __init__(self, count: int, low: int, high: int):
        self.count, self.floor, self.low, self.high = count, low, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self, low: np.ndarray, high: np.ndarray) -> float:
        """No score below is among the best, given bounds of candidates: `count` of them reach it for certain."""
        sure = low[(low >= self.low) & (high <= self.high)]
        if len(sure) < self.count:
            return self.low
        return max(self.low, np.partition(sure, -self.count)[-self.count])

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.low) & (scores <= self.high)
        if not fits.any():
            return
        scores = np.concatenate([self.scores, scores[fits]])
        ids = np.concatenate([self.ids, ids[fits]])
        best = np.lexsort((ids, ~scores))[: self.count]
        self.scores, self.ids = scores[best], ids[best]
        if len(best) == self.count:
            self.low = max(self.floor, int(self.scores[-1]))


def _window(positive: int) -> tuple[int, int]:
    return -((-LOW * positive) // HIGH), positive


class Block:
    """The anchors of a block, their tree, and what has been found for them.

    `windows[i]` has a `Best` per window of anchor i; `same` says whether rows of the anchor's label
    are wanted or those of others.
    """

    def __init__(self, row: dict, windows: list[dict[int, Best]], same: bool):
        self.number = row["block"]
        self.ids, self.labels, self.vectors = _read(row)
        self.parents = np.frombuffer(row["parents"], "<i8")
        self.lengths = np.frombuffer(row["lengths"], "<f8")
        self.windows, self.same = windows, same

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> int:
        """Look at a chunk of candidates; the number of scores that were computed."""
        product = Products(self.vectors, vectors)
        n, everything = len(ids), np.ones(len(ids), bool)
        low, high = np.empty((len(self.ids), n)), np.empty((len(self.ids), n))
        scored = 0
        for i, parent in enumerate(self.parents):
            wanted = ((labels == self.labels[i]) == self.same) & (ids != self.ids[i])
            if parent < 0 or not product.exact:
                rescored = everything
            else:
                reach = product.reach(self.lengths[i])
                np.subtract(low[parent], reach, out=low[i])
                np.add(high[parent], reach, out=high[i])
                overlap = np.zeros(n, bool)
                for best in self.windows[i].values():
                    overlap |= (high[i] >= best.least(low[i][wanted], high[i][wanted])) & (low[i] <= best.high)
                rescored = overlap & wanted
            which = np.flatnonzero(rescored)
            if not len(which):
                continue
            scored += len(which)
            # a matrix row at a time is cheaper than a choice of most rows
            if 2 * len(which) > n:
                scores = product(i, slice(None))[which]
            else:
                scores = product(i, which)
            low[i, which] = high[i, which] = scores
            kept = wanted[which]
            for best in self.windows[i].values():
                best.add(scores[kept], ids[which][kept])
        return scored

    def found(self) -> Iterator[tuple[int, int, int, int, int]]:
        for i, windows in enumerate(self.windows):
            for window, best in windows.items():
                for score, vec_id in zip(best.scores.tolist(), best.ids.tolist(), strict=True):
                    yield self.number, i, window, vec_id, score


def _search(blocks: DataFrame, chunks: DataFrame, lanes: int, same: bool) -> DataFrame:
    """(block, place, window, id, score): the best of each lane for each anchor and window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        # row by row: a row holds a whole chunk
        for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            if at != (row["block"], row["lane"]):
                if block is not None:
                    yield from _result(block.found())
                block, at = Block(row, _open(row, same), same), (row["block"], row["lane"])
            block.meet(*_read({c: row[f"c_{c}"] for c in ("ids", "labels", "kind", "width", "vectors")}))
        if block is not None:
            yield from _result(block.found())

    lane = F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int").alias("lane")
    candidates = chunks.select(lane, *[F.col(c).alias(f"c_{c}") for c in chunks.columns])
    everywhere = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    pairs = everywhere.join(candidates.hint("merge"), "lane")
    return pairs.mapInArrow(run, FOUND)


def _open(row: dict, same: bool) -> list[dict[int, Best]]:
    """The windows of a block's anchors at the start."""
    n = len(row["ids"]) // 8
    if same:
        return [{0: Best(POSITIVES, -LONG - 1, LONG)} for _ in range(n)]
    windows: list[dict[int, Best]] = [{} for _ in range(n)]
    for anchor in row["windows"]:
        for score in anchor["scores"]:
            low, high = _window(score)
            if low <= high:
                windows[anchor["place"]][score] = Best(NEGATIVES, low, high)
    return windows


def _result(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    if rows:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), [pa.int64(), pa.int32(), *[pa.int64()] * 3], strict=True)]
        yield pa.record_batch(columns, names=["block", "place", "window", "id", "score"])


def _best(found: DataFrame, count: int) -> DataFrame:
    order = W.partitionBy("block", "place", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(rows: DataFrame, vector: str, label: Column, is_anchor: Column, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has `vec_id`; `label` and `is_anchor` are expressions over its columns. An anchor whose positive
    has no negative within the window has no row for it.
    """
    flagged = rows.where(F.coalesce(is_anchor, F.lit(False)))
    chunks = materialize(_chunks(valid_rows(rows, vector, label), scale), "chunks")
    blocks = materialize(_blocks(valid_rows(flagged, vector, label), scale), "blocks")
    count = chunks.count()
    lanes = max(min(count, 1024), -(-count // LANE_CHUNKS), 1)

    with batches_of(rows.sparkSession, PAIRS):
        first = _best(_search(blocks, chunks, lanes, True), POSITIVES)
        positives = materialize(first.select("block", "place", "id", "score"), "positives")
    windows = positives.groupBy("block", "place").agg(F.collect_set("score").alias("scores"))
    windows = windows.groupBy("block").agg(F.collect_list(F.struct("place", "scores")).alias("windows"))
    again = blocks.join(windows, "block")
    with batches_of(rows.sparkSession, PAIRS):
        negatives = materialize(_best(_search(again, chunks, lanes, False), NEGATIVES), "negatives")
    negatives = negatives.select(
        "block", "place", F.col("window").alias("score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    names = blocks.select("block", F.posexplode("anchor_ids").alias("place", "anchor_id"))
    return (
        positives.join(negatives, ["block", "place", "score"])
        .join(names, ["block", "place"])
        .select(
            "anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id",
            F.col("score").alias("positive_score"), "negative_score",
        )
    )
