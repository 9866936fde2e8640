"""Boosted trees by histograms, for any number of classes and features.

Rows are cells (key, feature, value); an absent cell is a zero. Once, features are numbered in the order of their names, values
become the upper ends of their bins, and the cells of a row one pair of lists; `binned` does that, and calls on the
same cells share it. A round grows one tree per class, level by level: a row knows its gradients and, from its own
lists, its node, and they are summed by (feature, bin), for some nodes in one pass, so no level joins or moves cells. What a node's
rows without a cell add is the node's total less the sum of its cells, and the best split of each node is the maximum over all
bins. What reaches the driver is a split per node and class. Rows are written with their margins after each round, so
lineage does not grow and a model can go on from where another ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opinarium.functions.labels import softmax
from opinarium.operators.indexing import with_row_index
from opinarium.runtime import broadcast_if_small, materialize

LEAST = 1e-3  # of curvature on either side of a split
NODES = 8  # whose sums are taken in one pass over the cells


@dataclass
class Tree:
    """Splits (feature, border) by node and values by leaf; node n has children 2n (up to the border) and 2n + 1."""

    splits: dict[int, tuple[str, float]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def value(self, of: dict[str, Column], node: int = 1) -> Column:
        if node not in self.splits:
            return F.lit(self.values[node])
        feature, border = self.splits[node]
        low, high = self.value(of, 2 * node), self.value(of, 2 * node + 1)
        return F.when(of[feature] <= border, low).otherwise(high)


@dataclass
class Boosted:
    """Rounds of one tree per class, and the loss on held-out rows behind each round."""

    classes: int
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def features(self) -> list[str]:
        return sorted({f for trees in self.rounds for tree in trees for f, _ in tree.splits.values()})


def bin_borders(cells: DataFrame, bins: int) -> DataFrame:
    """(feature, borders, zero): upper ends of a feature's bins, ascending, and the bin of an absent cell.

    Quantiles of its distinct values, all of them where there are no more than `bins`, and zero.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    values = cells.select("feature", "value").distinct()
    found = values.groupBy("feature").agg(F.percentile_approx("value", shares, 100_000).alias("_q"))
    borders = F.sort_array(F.array_distinct(F.concat("_q", F.array(F.lit(0.0)))))
    return found.select("feature", borders.alias("borders")).withColumn(
        "zero", F.size(F.filter("borders", lambda b: b < 0.0))
    )


def _values(cells: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, _values): a map of the chosen features that a row has. As many as a model has splits."""
    named = cells.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    chosen = cells.join(F.broadcast(named), "feature")
    return chosen.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("_values"))


def _lookup(features: Sequence[str]) -> dict[str, Column]:
    return {f: F.coalesce(F.try_element_at("_values", F.lit(f)), F.lit(0.0)) for f in features}


def with_margins(rows: DataFrame, cells: DataFrame, key: str, model: Boosted) -> DataFrame:
    """The rows with `margins`, one per class: the sum of the trees. Softmax makes them probabilities."""
    features = model.features()
    if not features:
        constant = [sum(trees[k].values[1] for trees in model.rounds) for k in range(model.classes)]
        return rows.withColumn("margins", F.array(*[F.lit(float(c)) for c in constant]))
    of = _lookup(features)
    sums = [
        reduce(lambda a, b: a + b, [trees[k].value(of) for trees in model.rounds], F.lit(0.0))
        for k in range(model.classes)
    ]
    joined = rows.join(_values(cells, key, features), key, "left")
    return joined.withColumn("margins", F.array(*sums)).drop("_values")


@dataclass
class Binned:
    """Written features: (feature, number), in the order of the names, and rows (key, _ids, _ends) of all keys that have cells."""

    names: DataFrame
    rows: DataFrame


def binned(cells: DataFrame, train: DataFrame, key: str, bins: int = 32) -> Binned:
    """The cells by row, their values as ends of bins. Features and bins are those of the rows `train` (key).

    Where a feature has no more than `bins` values there, each is a bin of its own.
    """
    values = cells.join(train.select(key), key, "left_semi").select("feature", "value").distinct()
    values = materialize(values, "bin-values")
    sizes = materialize(values.groupBy("feature").agg(F.count("value").alias("_n")), "bin-sizes")
    names = with_row_index(sizes, ["feature"], "number")
    wide = names.where(F.col("_n") > bins).select("feature")
    numbered, end = cells.join(names, "feature"), F.col("value")
    if not wide.isEmpty():
        borders = materialize(bin_borders(values.join(wide, "feature", "left_semi"), bins), "borders")
        numbered = numbered.join(broadcast_if_small(borders.drop("zero")), "feature", "left")
        reached = F.get("borders", F.size(F.filter("borders", lambda b: b < F.col("value"))))
        # held-out values may lie above the last bin
        end = F.coalesce(reached, "value")
    rows = numbered.groupBy(key).agg(F.collect_list(F.struct("number", end.alias("end"))).alias("_c"))
    rows = rows.select(key, F.col("_c.number").alias("_ids"), F.col("_c.end").alias("_ends"))
    return Binned(names.select("feature", "number"), materialize(rows, "binned"))


def _own_values(numbers: dict[str, int]) -> dict[str, Column]:
    """The bins of the chosen features, from a row's own lists."""
    places = {f: F.array_position("_ids", F.lit(n).cast("long")).cast("int") - 1 for f, n in numbers.items()}
    return {f: F.coalesce(F.get("_ends", place), F.lit(0.0)) for f, place in places.items()}


def _node(tree: Tree, of: dict[str, Column], node: int = 1) -> Column:
    """The node a row has reached in a tree that is growing."""
    if node not in tree.splits:
        return F.lit(node)
    feature, border = tree.splits[node]
    return F.when(of[feature] <= border, _node(tree, of, 2 * node)).otherwise(_node(tree, of, 2 * node + 1))


def _state(rows: DataFrame, trees: list[Tree], numbers: dict[str, int], level: int) -> DataFrame:
    """Training rows with gradient and curvature of the softmax loss, and the node, per class."""
    of = _own_values(numbers)
    shares = rows.where(~F.col("held_out")).withColumn("_p", softmax(F.col("margins")))
    # rows of a repeated key count once more per copy and level, rows without a key at the root only
    weight = F.col("weight") * F.pow(F.col("_copies").cast("double"), F.lit(float(level)))
    g = F.transform("_p", lambda p, k: (p - (k == F.col("label")).cast("double")) * weight)
    h = F.transform("_p", lambda p: p * (1.0 - p) * weight)
    nodes = F.array(*[_node(tree, of) for tree in trees])
    return shares.select(g.alias("_g"), h.alias("_h"), nodes.alias("_node"), "_ids", "_ends")


def _parts(live: Sequence[tuple[int, int]]) -> dict[str, Column]:
    """Gradient and curvature of a row in each (class, node), NULL in the nodes it is not in."""
    return {
        f"{x}{i}": F.when(F.get("_node", F.lit(k)) == n, F.get(f"_{x}", F.lit(k)))
        for i, (k, n) in enumerate(live)
        for x in "gh"
    }


def _passes(live: Sequence[tuple[int, int]]) -> list[Sequence[tuple[int, int]]]:
    return [live[i : i + NODES] for i in range(0, len(live), NODES)]


def _totals(state: DataFrame, live: Sequence[tuple[int, int]]) -> dict[tuple[int, int], tuple[float, float]]:
    """Sums of gradient and curvature of those nodes that have rows."""
    sums = {}
    for some in _passes(live):
        found = state.agg(*[F.sum(c).alias(name) for name, c in _parts(some).items()]).first()
        sums |= {at: (found[f"g{i}"], found[f"h{i}"]) for i, at in enumerate(some)}
    return {at: both for at, both in sums.items() if both[1] is not None}


def _best_splits(state: DataFrame, totals: dict, live: Sequence[tuple[int, int]], l2: float) -> dict:
    """The best split (loss, number, border) of some nodes: by gain to nine digits, then the first feature and border."""
    parts = _parts(live)
    owned = state.select(*[c.alias(name) for name, c in parts.items()], F.arrays_zip("_ids", "_ends").alias("_c"))
    cells = owned.select(*parts, F.explode("_c").alias("_c"))
    sums = cells.groupBy(F.col("_c._ids").alias("number"), F.col("_c._ends").alias("border")).agg(
        *[F.sum(name).alias(name) for name in parts]
    )
    here = W.partitionBy("number").orderBy("border")
    upto = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    every = here.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    above = {name: F.when(F.col("border") > 0.0, F.col(name)) for name in parts}
    found = sums.select(
        "number", "border", F.row_number().over(here).alias("_place"),
        *[F.sum(name).over(upto).alias(f"{name}_upto") for name in parts],
        *[F.sum(name).over(every).alias(f"{name}_every") for name in parts],
        *[F.sum(c).over(every).alias(f"{name}_above") for name, c in above.items()],
    )

    def part(g: Column, h: Column) -> Column:
        return g * g / (h + l2)

    def best(border: Column, total: tuple[float, float], left: list[Column]) -> Column:
        gl, hl = left
        gr, hr = F.lit(total[0]) - gl, F.lit(total[1]) - hl
        gain = F.round(part(gl, hl) + part(gr, hr) - part(*map(F.lit, total)), 9)
        taken = (hl >= LEAST) & (hr >= LEAST) & (gain > 0)
        return F.min(F.when(taken, F.struct((-gain).alias("loss"), "number", border.alias("border"))))

    chosen = []
    for i, at in enumerate(live):
        # a split behind each bin that has cells, and one behind the zeros
        behind, zeros = [], []
        for name, total in zip((f"g{i}", f"h{i}"), totals[at], strict=True):
            absent = F.lit(total) - F.col(f"{name}_every")
            behind.append(F.col(f"{name}_upto") + F.when(F.col("border") >= 0.0, absent).otherwise(0.0))
            zeros.append(F.when(F.col("_place") == 1, F.lit(total) - F.col(f"{name}_above")))
        both = best(F.col("border"), totals[at], behind), best(F.lit(0.0), totals[at], zeros)
        chosen.append(F.least(*both).alias(f"best{i}"))
    row = found.agg(*chosen).first()
    return {at: row[f"best{i}"] for i, at in enumerate(live) if row[f"best{i}"] is not None}


def boost(
    rows: DataFrame,
    cells: DataFrame,
    key: str,
    classes: int,
    rounds: int,
    depth: int = 3,
    learning_rate: float = 0.1,
    l2: float = 1.0,
    bins: int = 32,
    patience: int | None = None,
    start: Boosted | None = None,
    features: Binned | None = None,
) -> Boosted:
    """Trees for `rows` (key, label, optional weight, optional held_out), going on from `start`.

    Rows that are held out take no part in the trees; with `patience`, boosting stops when their loss has not
    fallen for as many rounds, and the model ends with the best round. Pass written rows and cells; keys are
    unique, and a row has one cell per feature at most. `features` are the cells' bins, where several calls share
    them: `binned` of the rows that are not held out.
    """
    model = Boosted(classes, list(start.rounds) if start else [], list(start.losses) if start else [])
    held = F.coalesce("held_out", F.lit(False)) if "held_out" in rows.columns else F.lit(False)
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    own = rows.select(key, F.col("label").cast("int").alias("label"), weight.alias("weight"), held.alias("held_out"))
    margins = with_margins(own, cells, key, start) if start else own.withColumn(
        "margins", F.array_repeat(F.lit(0.0), F.lit(classes))
    )
    copies = F.when(F.col(key).isNull(), 0).otherwise(F.count("*").over(W.partitionBy(key)))
    margins = margins.withColumn("_copies", copies)
    if features is None:
        features = binned(cells, own.where(~F.col("held_out")), key, bins)
    margins = materialize(margins.join(features.rows, key, "left"), "margins")
    best, least = len(model.rounds), _held_out_loss(margins)
    for n in range(rounds):
        trees, numbers = [Tree() for _ in range(classes)], {}
        state = _state(margins, trees, numbers, 0)
        live = [(k, 1) for k in range(classes)]
        for level in range(depth):
            totals = _totals(state, live)
            found = {}
            for some in _passes([at for at in live if at in totals]):
                found |= _best_splits(state, totals, some, l2)
            if not found:
                break
            chosen = features.names.where(F.col("number").isin([split["number"] for split in found.values()])).collect()
            numbers |= {r["feature"]: r["number"] for r in chosen}
            named = {r["number"]: r["feature"] for r in chosen}
            live = []
            for (k, node), split in sorted(found.items()):
                trees[k].splits[node] = (named[split["number"]], split["border"])
                live += [(k, 2 * node), (k, 2 * node + 1)]
            state = _state(margins, trees, numbers, level + 1)
        leaves = [(k, node) for k, tree in enumerate(trees) for node in _leaves(tree)]
        for (k, node), (g, h) in _totals(state, leaves).items():
            trees[k].values[node] = -learning_rate * g / (h + l2)
        for k, node in leaves:
            # a leaf that only held-out rows reach changes nothing; without training rows all are such
            trees[k].values.setdefault(node, 0.0)
        of = _own_values(numbers)
        step = F.array(*[tree.value(of) for tree in trees])
        margins = margins.withColumn("margins", F.zip_with("margins", step, lambda m, s: m + s))
        if n + 1 < rounds:
            margins = materialize(margins, "margins")
        model.rounds.append(trees)
        model.losses.append(_held_out_loss(margins))
        if model.losses[-1] < least:
            best, least = len(model.rounds), model.losses[-1]
        elif patience is not None and len(model.rounds) - best >= patience:
            break
    if patience is not None:
        model.rounds, model.losses = model.rounds[:best], model.losses[:best]
    return model


def _leaves(tree: Tree) -> list[int]:
    return [n for m in tree.splits for n in (2 * m, 2 * m + 1) if n not in tree.splits] or [1]


def _held_out_loss(rows: DataFrame) -> float:
    """Mean cross-entropy of the held-out rows, of all rows where none is."""
    share = F.get(softmax(F.col("margins")), F.col("label"))
    loss = -F.ln(share) * F.col("weight")
    means = [
        F.sum(F.when(keep, loss)) / F.sum(F.when(keep, F.col("weight"))) for keep in (F.col("held_out"), F.lit(True))
    ]
    held, every = rows.agg(*means).first()
    return held if held is not None else (every or 0.0)
