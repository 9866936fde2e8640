"""Sharding by fixed virtual slots and a versioned slot map.

A row belongs to one of thousands of virtual slots by the hash of its text, so equal texts stay
together. A small map says which shard holds a slot. Version 0 deals slots out in turn;
rebalancing reads the bytes per slot and edits the map by moving slots from heavy shards to light
ones, each edit a new version, so data moves in whole slots only. Only functions of Spark SQL
touch the rows; the map has one row per slot whatever the data, and is what the driver sees and
broadcasts.

The law of the dealt shards is `bytes`: sizes are equal up to the bytes of a slot. A row is never
split, so no dealing can even out a table whose longest text outweighs a shard. A group of
equal texts that outweighs a shard is spread over the slots by doc_id; there are fewer such groups
than shards, and the map names them.

NULL texts are spread by doc_id. NULL and empty texts weigh one byte. Repeated rows share a slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 4096

# A slot's rows are ranked in this many parts, so that a slot of many copies is no single task.
PARTS = 16

MAP_SCHEMA = "version int, slot int, shard int, bytes long, n_rows array<long>, spread array<long>"


def text_hash() -> Column:
    return F.xxhash64("text")


def slot_of(slots: int = SLOTS, spread: Sequence[int] = ()) -> Column:
    """The virtual slot of a row with `doc_id` and `text`; `spread` are hashes of heavy texts."""
    alone = F.col("text").isNull()
    if spread:
        alone = alone | text_hash().isin(list(spread))
    owner = F.when(alone, F.xxhash64("doc_id", "text")).otherwise(text_hash())
    return F.pmod(owner, F.lit(slots)).cast("int")


def part_of() -> Column:
    return F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(PARTS)).cast("int")


def row_size() -> Column:
    """UTF-8 bytes of the text (none for NULL) plus 1."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def heavy_texts(docs: DataFrame, shards: int) -> list[int]:
    """Hashes of the texts whose copies outweigh a shard: fewer than there are shards."""
    sizes = docs.where("text is not null").select(text_hash().alias("hash"), row_size().alias("size"))
    groups = sizes.groupBy("hash").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    heavy = groups.where((F.col("n") > 1) & (F.col("bytes") > total / shards))
    return sorted(r["hash"] for r in heavy.collect())


# (slot, bytes, rows of each part)
Totals = list[tuple[int, int, tuple[int, ...]]]


def slot_totals(docs: DataFrame, slots: int = SLOTS, spread: Sequence[int] = ()) -> Totals:
    """What the slots in use hold; `slots` times `PARTS` numbers at most come to the driver."""
    totals = (
        docs.select(slot_of(slots, spread).alias("slot"), part_of().alias("part"), row_size().alias("size"))
        .groupBy("slot", "part")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))
    )
    found: dict[int, tuple[int, list[int]]] = {}
    for r in totals.collect():
        size, rows = found.setdefault(r["slot"], (0, [0] * PARTS))
        rows[r["part"]] = r["n_rows"]
        found[r["slot"]] = size + r["bytes"], rows
    return [(slot, size, tuple(rows)) for slot, (size, rows) in sorted(found.items())]


@dataclass(frozen=True)
class SlotMap:
    """Which shard holds a slot, in one version, with what the slots held when it was made."""

    version: int
    shards: int
    shard: tuple[int, ...]  # by slot
    bytes: tuple[int, ...]
    rows: tuple[tuple[int, ...], ...]  # by slot and part
    spread: tuple[int, ...] = ()  # hashes of texts that are spread by doc_id

    def loads(self) -> list[int]:
        total = [0] * self.shards
        for shard, size in zip(self.shard, self.bytes, strict=True):
            total[shard] += size
        return total

    def edited(self, shard: Sequence[int], shards: int) -> SlotMap:
        """The next version."""
        return replace(self, version=self.version + 1, shard=tuple(shard), shards=shards)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.version, s, self.shard[s], self.bytes[s], list(self.rows[s]), list(self.spread))
            for s in range(len(self.shard))
        ]
        return spark.createDataFrame(rows, MAP_SCHEMA)


def first_map(totals: Totals, shards: int, slots: int = SLOTS, spread: Sequence[int] = ()) -> SlotMap:
    """Version 0: slots dealt out in turn."""
    sizes, rows = [0] * slots, [(0,) * PARTS] * slots
    for slot, size, n in totals:
        sizes[slot], rows[slot] = size, tuple(n)
    dealt = tuple(s % shards for s in range(slots))
    return SlotMap(0, shards, dealt, tuple(sizes), tuple(rows), tuple(spread))


def rebalanced(current: SlotMap) -> SlotMap:
    """The next version: slots move from the heaviest to the lightest shard, then are swapped.

    Each step takes the move, or the exchange of two slots, that brings the two nearest to equal;
    it ends when none brings them nearer.
    """
    shard, loads = list(current.shard), current.loads()
    held: list[set[int]] = [set() for _ in range(current.shards)]
    for slot, place in enumerate(shard):
        if current.bytes[slot]:
            held[place].add(slot)
    while True:
        heavy = max(range(current.shards), key=lambda s: (loads[s], -s))
        light = min(range(current.shards), key=lambda s: (loads[s], s))
        gap = loads[heavy] - loads[light]
        if gap <= 1:
            break
        give = sorted((current.bytes[s], s) for s in held[heavy])
        take = [(0, -1), *sorted((current.bytes[s], s) for s in held[light])]
        best, at = None, 0
        for size, slot in give:  # the partner whose difference is next to half the gap
            while at + 1 < len(take) and size - take[at + 1][0] >= gap / 2:
                at += 1
            for near in (at, at + 1, max(at - 1, 0)):
                if near < len(take) and 0 < size - take[near][0] < gap:
                    off = abs(gap - 2 * (size - take[near][0]))
                    if best is None or (off, slot) < best[:2]:
                        best = off, slot, take[near][1]
        if best is None or best[0] >= gap:
            break
        for slot, old, new in ((best[1], heavy, light), (best[2], light, heavy)):
            if slot >= 0:
                held[old].remove(slot)
                held[new].add(slot)
                shard[slot] = new
                loads[old] -= current.bytes[slot]
                loads[new] += current.bytes[slot]
    return current.edited(shard, current.shards)


def grown(current: SlotMap) -> SlotMap:
    """The next version with one shard more, which takes slots from the heaviest shards in turn."""
    shard, loads = list(current.shard), [*current.loads(), 0]
    new, goal = current.shards, sum(current.bytes) / (current.shards + 1)
    held = [sorted((current.bytes[s], s) for s, p in enumerate(shard) if p == k) for k in range(new)]
    while True:
        heavy = max(range(new), key=lambda s: (loads[s], -s))
        if not held[heavy] or loads[new] + held[heavy][-1][0] > max(goal, loads[heavy]):
            break
        size, slot = held[heavy].pop()
        if not size:
            break
        shard[slot] = new
        loads[heavy] -= size
        loads[new] += size
    return current.edited(shard, new + 1)


def save_map(spark: SparkSession, made: SlotMap, folder: str) -> None:
    """Add a version to the stored map; writing a version again replaces it."""
    part = f"{folder.rstrip('/')}/version={made.version}"
    made.to_frame(spark).drop("version").write.mode("overwrite").parquet(part)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """One stored version, the latest by default."""
    stored = spark.read.parquet(folder)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).orderBy("slot").collect()
    shard, sizes = (tuple(r[c] for r in rows) for c in ("shard", "bytes"))
    held = tuple(tuple(r["n_rows"]) for r in rows)
    return SlotMap(version, max(shard) + 1, shard, sizes, held, tuple(rows[0]["spread"]))


def assign(docs: DataFrame, made: SlotMap) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot): each row's shard and place in it.

    Places count from 0 without gap in each shard: the rows of the shard's earlier parts of slots,
    known from the map, plus the rank within the part, so that no window spans a shard.
    The map must be made from the same rows.
    """
    spark = docs.sparkSession
    begin, seen = [], [0] * made.shards
    for slot, shard in enumerate(made.shard):
        for part, n in enumerate(made.rows[slot]):
            if n:
                begin.append((slot, part, shard, seen[shard]))
                seen[shard] += n
    table = spark.createDataFrame(begin, "virtual_slot int, part int, shard int, begin long")
    rows = docs.select(
        "doc_id",
        row_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        slot_of(len(made.shard), made.spread).alias("virtual_slot"),
        part_of().alias("part"),
    )
    # at most one row per part of a slot, whatever the data
    ranked = rows.join(F.broadcast(table), ["virtual_slot", "part"]).selectExpr(
        "*",
        "row_number() over (partition by virtual_slot, part order by doc_id, text_crc32, size) - 1 as rank",
    )
    return ranked.select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", (F.col("begin") + F.col("rank")).alias("slot")
    )


def balanced_map(docs: DataFrame, shards: int = 16, slots: int = SLOTS) -> SlotMap:
    """A map of the table's own slots, rebalanced once."""
    spread = heavy_texts(docs, shards)
    return rebalanced(first_map(slot_totals(docs, slots, spread), shards, slots, spread))


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS) -> DataFrame:
    """Every document's shard 0 to `shards` - 1 under a balanced map."""
    return assign(docs, balanced_map(docs, shards, slots))


def write_shards(docs: DataFrame, made: SlotMap, folder: str) -> None:
    """The documents themselves, one folder per shard, in tasks that each hold some slots."""
    table = docs.sparkSession.createDataFrame(list(enumerate(made.shard)), "_slot int, _shard int")
    slot = slot_of(len(made.shard), made.spread)
    placed = docs.withColumn("_slot", slot).join(F.broadcast(table), "_slot")
    placed.drop("_slot").write.partitionBy("_shard").parquet(folder)
