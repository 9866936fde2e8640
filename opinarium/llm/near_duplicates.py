"""Near-duplicate classes: BagMinHash signatures, bands, and verified multiset overlap.

A text is the multiset of its five-word shingles. For each shingle, weights are laid out on an axis
that is cut at 1, 2, 4, 8, ...; over every piece runs a Poisson process whose rate is the width
of the piece and whose points carry a register and, by further halving of the piece, a
position. A text sees the points whose position lies below its count, so the earliest point
of a register is the same in two texts with the probability of their weighted Jaccard
similarity. Points are made in order of time up to a bound that fills all registers, so few are
made beyond the first of each shingle.

Nodes of the search are distinct texts, by the MD5 of their characters. Texts that share a band meet in a
bucket. A bucket is not paired out: each member is compared with the bucket's leader, first the
member that meets most texts over all its buckets, then any other one, and the verified links are
joined into components. What is left are pairs of different components in one bucket. In a
small bucket they are listed where their signatures allow it (an estimate under `SURE_BELOW` is more than five
standard deviations from 0.8) and compared. A large bucket is dealt into blocks, and a task takes two
blocks: it computes all overlaps of their members as one product of incidence matrices and gives back
only links that join components. Thus no link between texts that share a band is lost, and the
rows a group makes grow with its size.

Equal texts are one class, empty ones included. Texts without a word have no shingles and no other
link. A row with NULL text is a class of its own. The id of a class is its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import chunks, packed
from opinarium.llm.shingles import ID_BITS, MAX_TEXTS, Shingles, mix, shingles, word_characters
from opinarium.runtime import broadcast_if_small, materialize

BANDS, BAND_ROWS = 24, 5
REGISTERS = BANDS * BAND_ROWS
THRESHOLD = 0.8
SURE_BELOW = 0.6
LEADER_ROUNDS = 2
# Members up to which the open pairs of a bucket are listed, and members of a block beyond that.
LISTED_BUCKET = 64
BLOCK = 256
# Characters that one call turns into arrays, and what the shortest text counts as, so that no
# call gets more texts than shingle keys have room for.
CHUNK_CHARS = 1 << 18
LEAST_SIZE = CHUNK_CHARS // MAX_TEXTS + 1
MATRIX_COLUMNS = 1 << 13


def _streams(text: np.ndarray, ids: np.ndarray, count: np.ndarray):
    """One Poisson stream per shingle and piece of its weight axis: (element, number, low, width)."""
    element = np.arange(len(ids))
    parts = [(element, np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64))]
    piece, low = 1, 1
    while (more := np.flatnonzero(count > low)).size:
        full = np.full(len(more), low)
        parts.append((more, np.full(len(more), piece), full, full))
        piece, low = piece + 1, low * 2
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _earliest(text, ids, count, bound, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Time and mark of the earliest point of each register of each text up to its bound."""
    element, piece, low, width = _streams(text, ids, count)
    state = mix(ids[element] + (piece.astype(np.uint64) << np.uint64(ID_BITS)))
    owner, limit, rate = text[element], bound[text[element]], width.astype(float)
    reach = np.minimum(count[element] - low, width)
    time = np.zeros(len(element))
    places, times, marks = [], [], []
    while len(state):
        state = state * np.uint64(6364136223846793005) + np.uint64(1442695040888963407)
        drawn = mix(state)
        time = time + -np.log1p((drawn >> np.uint64(11)) * -(2.0**-53)) / rate
        live = time <= limit
        state, owner, limit, rate, width, reach, time = (
            x[live] for x in (state, owner, limit, rate, width, reach, time)
        )
        mark = mix(drawn[live] + np.uint64(0x9E3779B97F4A7C15))
        register = ((mark >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        position = ((mark & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64)) >> np.uint64(32)
        seen = position.astype(np.int64) < reach
        places.append((owner * REGISTERS + register.astype(np.int64))[seen])
        times.append(time[seen])
        marks.append(mark[seen])
    place, time, mark = (np.concatenate(x) for x in (places, times, marks))
    first = np.full(texts * REGISTERS, np.inf)
    np.minimum.at(first, place, time)
    found = np.zeros(texts * REGISTERS, np.uint32)
    winner = time == first[place]
    found[place[winner]] = (mix(mark[winner]) >> np.uint64(32)).astype(np.uint32)
    return first.reshape(texts, REGISTERS), found.reshape(texts, REGISTERS)


def signatures(texts: list[str], table: np.ndarray) -> list[bytes | None]:
    """The packed signature of each text, None for a text without a word."""
    found = shingles(texts, table)
    result: list[bytes | None] = [None] * len(texts)
    todo = np.flatnonzero(found.totals)
    reach = REGISTERS * (np.log(REGISTERS) + 7.0)
    while len(todo):
        renumbered = np.full(len(texts), -1)
        renumbered[todo] = np.arange(len(todo))
        mine = renumbered[found.text] >= 0
        bound = reach / found.totals[todo]
        first, marks = _earliest(
            renumbered[found.text[mine]], found.ids[mine], found.count[mine], bound, len(todo)
        )
        full = np.isfinite(first).all(axis=1)
        for i in np.flatnonzero(full):
            result[todo[i]] = marks[i].tobytes()
        todo, reach = todo[~full], reach * 2
    return result


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (ids, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _sizes(column) -> np.ndarray:
    """Characters of each text, and a share of the texts that fit into one call."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False) + LEAST_SIZE


def _sign(keyed: DataFrame) -> DataFrame:
    """(doc_id, key, sig) of (doc_id, key, text); few texts at a time leave the batch."""
    table = keyed.sparkSession.sparkContext.broadcast(word_characters())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = pa.table(batch)
            for part in chunks(_sizes(batch.column("text")), CHUNK_CHARS):
                few = rows.slice(part.start, part.stop - part.start)
                made = signatures(few["text"].to_pylist(), table.value)
                few = few.drop_columns("text").append_column("sig", pa.array(made, pa.binary()))
                yield from few.to_batches()

    return keyed.select("doc_id", "key", "text").mapInArrow(run, "doc_id long, key binary, sig binary")


def _compare(pairs: DataFrame) -> DataFrame:
    """(a, b, similarity) of (a, b, left, right)."""
    table = pairs.sparkSession.sparkContext.broadcast(word_characters())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = pa.table(batch)
            sizes = _sizes(batch.column("left")) + _sizes(batch.column("right"))
            for part in chunks(sizes, CHUNK_CHARS):
                few = rows.slice(part.start, part.stop - part.start)
                left = shingles(few["left"].to_pylist(), table.value)
                right = shingles(few["right"].to_pylist(), table.value)
                alike = [overlap(left.of(i), right.of(i)) for i in range(few.num_rows)]
                few = few.select(["a", "b"]).append_column("similarity", pa.array(alike, pa.float64()))
                yield from few.to_batches()

    columns = pairs.select("a", "b", "left", "right")
    return columns.mapInArrow(run, "a binary, b binary, similarity double")


def text_key(text: str = "text") -> Column:
    """16 bytes that stand for the text; NULL for NULL."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def _with_keys(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", text_key().alias("key"))


def _overlaps(left: Shingles, right: Shingles) -> np.ndarray:
    """Weighted Jaccard similarity of all texts of one side with all of the other.

    A repeated shingle counts as several elements, its first, second, ... occurrence, so that
    multisets become sets and shared elements a product of two 0/1 matrices, made for some
    elements at a time.
    """

    def elements(side: Shingles) -> tuple[np.ndarray, np.ndarray]:
        first = np.cumsum(side.count) - side.count
        nth = np.arange(side.count.sum()) - np.repeat(first, side.count)
        return np.repeat(side.text, side.count), mix(
            np.repeat(side.ids, side.count) + (nth.astype(np.uint64) << np.uint64(ID_BITS))
        )

    (texts_a, a), (texts_b, b) = elements(left), elements(right)
    common = np.intersect1d(a, b)
    shared = np.zeros((len(left.totals), len(right.totals)), np.float32)
    for start in range(0, len(common), MATRIX_COLUMNS):
        some = common[start : start + MATRIX_COLUMNS]
        sides = []
        for texts, values, n in ((texts_a, a, len(left.totals)), (texts_b, b, len(right.totals))):
            place = np.minimum(np.searchsorted(some, values), len(some) - 1)
            here = some[place] == values
            matrix = np.zeros((n, len(some)), np.float32)
            matrix[texts[here], place[here]] = 1.0
            sides.append(matrix)
        shared += sides[0] @ sides[1].T
    total = left.totals[:, None] + right.totals[None, :] - shared
    return np.where(total > 0, shared / np.maximum(total, 1), 0.0)


def _spanning(links: Iterable[tuple[int, int]], parts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Of links between rows, those that join components not joined before."""
    root: dict[bytes, bytes] = {}

    def find(part: bytes) -> bytes:
        while (above := root.get(part, part)) != part:
            part = above
        return part

    for i, j in links:
        x, y = find(parts[i]), find(parts[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            yield i, j


def _link_blocks(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): verified links that join components, from (band, i, j, asked, key, part, text).

    A group (band, i, j) holds the asked texts of one block and all texts of another one.
    """
    table = rows.sparkSession.sparkContext.broadcast(word_characters())

    def run(group: pd.DataFrame) -> pd.DataFrame:
        asked, others = group[group["asked"]], group[~group["asked"]]
        if not len(asked) or not len(others):
            return pd.DataFrame({"a": [], "b": []}, dtype=object)
        alike = _overlaps(
            shingles(asked["text"].tolist(), table.value), shingles(others["text"].tolist(), table.value)
        )
        parts = [*asked["part"], *others["part"]]
        keys = [*asked["key"], *others["key"]]
        found = np.argwhere(alike >= threshold)
        links = ((int(i), len(asked) + int(j)) for i, j in found)
        kept = list(_spanning(links, parts))
        return pd.DataFrame({"a": [keys[i] for i, _ in kept], "b": [keys[j] for _, j in kept]}, dtype=object)

    return rows.groupBy("band", "i", "j").applyInPandas(run, "a binary, b binary")


def _bands(texts: DataFrame) -> DataFrame:
    """(band, key): one row per band of a signature."""
    size = BAND_ROWS * 4
    hashes = [
        F.xxhash64(F.lit(i), F.substring("sig", i * size + 1, size)) for i in range(BANDS)
    ]
    return texts.where("sig is not null").select("key", F.explode(F.array(*hashes)).alias("band"))


def components(links: DataFrame) -> DataFrame:
    """(key, part) of every key in links (a, b): the smallest key of its connected component.

    Each round takes the smallest label among neighbours and then the label of the label, so
    rounds grow with the logarithm of a component's width. Every round is written.
    """
    both = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    labels = materialize(
        both.groupBy(F.col("a").alias("key")).agg(F.least("key", F.min("b")).alias("part")), "labels"
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("key", "b"), "b")
            .groupBy(F.col("a").alias("key"))
            .agg(F.min("part").alias("near"))
        )
        after = labels.join(near, "key").select(
            "key", "part", F.least("part", "near").alias("next")
        )
        jump = labels.select(F.col("key").alias("next"), F.col("part").alias("far"))
        after = after.join(jump, "next").select(
            "key", F.col("far").alias("part"), (F.col("far") != F.col("part")).alias("moved")
        )
        labels = materialize(after, "labels")
        if labels.where("moved").isEmpty():
            return labels.select("key", "part")


def _renamed(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after new links: known ones are merged by the components of their names."""
    if known is None:
        return components(links)
    for side in ("a", "b"):
        names = known.select(F.col("key").alias(side), F.col("part").alias("name"))
        links = links.join(names, side, "left").withColumn(side, F.coalesce("name", side)).drop("name")
    merged = components(links.where("a != b").distinct())
    moved = merged.select(F.col("key").alias("part"), F.col("part").alias("now"))
    old = known.join(moved, "part", "left").select("key", F.coalesce("now", "part").alias("part"))
    new = merged.join(known, "key", "left_anti")
    return materialize(old.unionByName(new).distinct(), "parts")


def _dealt(placed: DataFrame) -> DataFrame:
    """(band, i, j, asked, key, part) of (band, key, part, n): asked members by block i, all by block j.

    There are as many blocks i as the asked members, those outside the largest component, fill, so
    the others are repeated no more often than blocks ask.
    """
    counts = placed.groupBy("band", "part").agg(F.count("*").alias("c"))
    largest = counts.groupBy("band").agg(F.max(F.struct("c", "part")).alias("most"))
    sided = placed.join(materialize(largest, "largest"), "band").select(
        "band", "key", "part",
        (F.col("part") != F.col("most.part")).alias("small"),
        F.ceil((F.col("n") - F.col("most.c")) / BLOCK).cast("int").alias("asking"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
    )

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    asked = sided.where("small").select(
        "band", own("asking").alias("i"), each("blocks").alias("j"), F.lit(True).alias("asked"), "key", "part"
    )
    others = sided.where("asking > 0").select(
        "band", each("asking").alias("i"), own("blocks").alias("j"), F.lit(False).alias("asked"), "key", "part"
    )
    return asked.unionByName(others)


class _Search:
    """The state of one search: band members, texts, verified links, tested pairs."""

    def __init__(self, docs: DataFrame, threshold: float):
        self.threshold = threshold
        self.spark = docs.sparkSession
        keyed = _with_keys(docs)
        self.texts = materialize(
            _sign(keyed.where("text is not null"))
            .groupBy("key")
            .agg(F.min("doc_id").alias("first_id"), F.first("sig").alias("sig")),
            "signed",
        )
        bands = _bands(self.texts)
        shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
        met = materialize(bands.join(shared, "band"), "met")
        reach = met.groupBy("key").agg(F.sum("n").alias("reach"))
        # (band, key, reach): how many texts a key meets over all its buckets
        self.members = materialize(
            met.join(materialize(reach, "reach"), "key").select("band", "key", "reach"), "members"
        )
        wanted = self.members.select("key").distinct().join(self.texts, "key")
        wanted = broadcast_if_small(materialize(wanted.select("key", "first_id"), "wanted"))
        same = keyed["key"].eqNullSafe(wanted["key"]) & keyed["doc_id"].eqNullSafe(wanted["first_id"])
        self.bodies = materialize(
            keyed.join(wanted, same).select(keyed["key"], "text").dropDuplicates(["key"]), "bodies"
        )
        self.parts: DataFrame | None = None
        self.tested: DataFrame | None = None

    def _placed(self) -> DataFrame:
        """Members with their component, of the buckets that hold several."""
        if self.parts is None:
            placed = self.members.withColumn("part", F.col("key"))
        else:
            placed = self.members.join(self.parts, "key", "left").withColumn(
                "part", F.coalesce("part", "key")
            )
        mixed = (
            placed.groupBy("band")
            .agg(F.min("part").alias("least"), F.max("part").alias("most"))
            .where("least != most")
            .select("band")
        )
        return materialize(placed.join(mixed, "band"), "open")

    def _new(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a < b) that have not been compared yet, once each."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        return materialize(pairs, "pairs")

    def _verify(self, pairs: DataFrame) -> None:
        """Compare texts of the pairs and merge the components that a link joins."""
        left = self.bodies.select(F.col("key").alias("a"), F.col("text").alias("left"))
        right = self.bodies.select(F.col("key").alias("b"), F.col("text").alias("right"))
        compared = pairs.join(left, "a").join(right, "b")
        links = materialize(
            _compare(compared)
            .where(F.col("similarity") >= self.threshold)
            .select("a", "b"),
            "verified",
        )
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        if not links.isEmpty():
            self.parts = _renamed(self.parts, links)

    def by_leaders(self, turn: int) -> bool:
        """Compare members with a leader of their bucket; False when no bucket is left open."""
        placed = self._placed()
        if placed.isEmpty():
            return False
        rank = F.xxhash64("key", F.lit(turn)) if turn else -F.col("reach")
        order = F.struct(rank.alias("order"), "key", "part")
        leaders = placed.groupBy("band").agg(F.min(order).alias("leader"))
        pairs = placed.join(materialize(leaders, "leaders"), "band").where("part != leader.part")
        pairs = self._new(pairs.select(F.col("key").alias("a"), F.col("leader.key").alias("b")))
        if not pairs.isEmpty():
            self._verify(pairs)
        return True

    def rest(self) -> None:
        """Compare what is left: pairs of different components in one bucket."""
        placed = self._placed().select("band", "key", "part")
        if placed.isEmpty():
            return
        sizes = materialize(placed.groupBy("band").agg(F.count("*").alias("n")), "sizes")
        sized = materialize(placed.join(sizes, "band"), "sized")
        self._list_pairs(sized.where(F.col("n") <= LISTED_BUCKET))
        large = sized.where(F.col("n") > LISTED_BUCKET)
        if not large.isEmpty():
            self._by_blocks(large)

    def _list_pairs(self, placed: DataFrame) -> None:
        """Compare the open pairs of small buckets whose signatures do not rule a link out."""
        placed = materialize(placed.join(self.texts.select("key", "sig"), "key"), "listed")
        a, b = placed.alias("x"), placed.alias("y")
        equal = F.aggregate(
            F.sequence(F.lit(0), F.lit(REGISTERS - 1)),
            F.lit(0),
            lambda n, i: n
            + (F.substring("x.sig", i * 4 + 1, F.lit(4)) == F.substring("y.sig", i * 4 + 1, F.lit(4))).cast("int"),
        )
        met = (
            (F.col("x.band") == F.col("y.band"))
            & (F.col("x.part") < F.col("y.part"))
            & (equal >= int(SURE_BELOW * REGISTERS))
        )
        pairs = a.join(b, met).select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        pairs = self._new(pairs)
        if not pairs.isEmpty():
            self._verify(pairs)

    def _by_blocks(self, placed: DataFrame) -> None:
        """Compare, block by block, the members outside a bucket's largest component with all."""
        rows = materialize(_dealt(placed), "blocks").join(self.bodies, "key")
        links = materialize(_link_blocks(rows, self.threshold), "verified")
        if not links.isEmpty():
            self.parts = _renamed(self.parts, links)

    def classes(self) -> DataFrame:
        """(key, class_key, class_id, first_id): each text's class, the key and id of its first text."""
        for turn in range(LEADER_ROUNDS):
            if not self.by_leaders(turn):
                break
        else:
            self.rest()
        texts = self.texts.select("key", "first_id")
        if self.parts is None:
            return materialize(
                texts.select(
                    "key", F.col("key").alias("class_key"), F.col("first_id").alias("class_id"), "first_id"
                ),
                "classes",
            )
        placed = materialize(
            texts.join(self.parts, "key", "left").withColumn("part", F.coalesce("part", "key")), "placed"
        )
        order = F.struct(F.col("first_id").isNull().alias("n"), "first_id", "key")
        heads = placed.groupBy("part").agg(F.min(order).alias("head"))
        return materialize(
            placed.join(materialize(heads, "heads"), "part").select(
                "key",
                F.col("head.key").alias("class_key"),
                F.col("head.first_id").alias("class_id"),
                "first_id",
            ),
            "classes",
        )


def text_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, class_key) of the distinct texts of `docs`; `text_key` makes the key."""
    return _Search(docs.select("doc_id", "text"), threshold).classes().select("key", "class_key")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size), a row per document; links are texts of `threshold` or more."""
    classes = _Search(docs.select("doc_id", "text"), threshold).classes()
    rows = _with_keys(docs).select("doc_id", "key")
    placed = rows.join(classes.select("key", "class_key", "class_id"), "key", "left")
    placed = materialize(placed, "classified")
    sizes = placed.where("key is not null").groupBy("class_key").agg(F.count("*").alias("size"))
    sized = placed.join(materialize(sizes, "sizes"), "class_key", "left")
    return sized.select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class with the columns of `docs`; rows without text all stay.

    The row with the class's smallest doc_id stays, and one of rows that repeat it.
    """
    classes = _Search(docs.select("doc_id", "text"), threshold).classes()
    rows = packed(docs, "doc_id").withColumn("key", text_key("row.text"))
    counted = rows.where("key is not null").groupBy("doc_id", "key").agg(F.count("*").alias("n"))
    known = materialize(counted, "counted")
    stays = classes.where("key = class_key").select("key", "first_id")
    here = (known["key"] == stays["key"]) & known["doc_id"].eqNullSafe(stays["first_id"])
    gone = materialize(known.join(stays, here, "left_anti").select("doc_id", "key"), "gone")
    gone = broadcast_if_small(gone)
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["key"] == gone["key"])
    left = rows.join(gone, same, "left_anti")
    again = materialize(known.where("n > 1").select("doc_id", "key"), "again")
    if again.isEmpty():
        return left.select("row.*")
    again = broadcast_if_small(again)
    twice = left["doc_id"].eqNullSafe(again["doc_id"]) & (left["key"] == again["key"])
    once = left.join(again, twice, "left_anti")
    repeated = left.join(again, twice, "left_semi").dropDuplicates(["doc_id", "key"])
    return once.unionByName(repeated).select("row.*")
