"""Document fingerprints: one-permutation MinHash in SQL functions only.

All shingles (five lower-case words, a shorter text being one shingle) are hashed once. The high
bits choose one of 256 bins and the smallest hash of a bin represents it: the hashes are sorted and the
first of each bin is kept, so no row is exploded. An empty bin copies another bin
by probes that depend on its number only (optimal densification): a sequence of hashed tries, and
when those meet empty bins only, the filled bin whose hash with the number is smallest. The low
four bits of each bin, hashed with its number, are kept as 256 hexadecimal digits. Unrelated digits agree by chance in one of
sixteen, so two fingerprints that agree in a share p of their digits have the likeness
(p - 1/16) / (1 - 1/16), or 0 if that is negative.

NULL counts as the empty text, whose one shingle is the empty one. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.runtime import materialize

BINS = 256
DIGIT_BITS = 4
SHINGLE_WORDS = 5
PROBES = 12
CHANCE = 1 / (1 << DIGIT_BITS)

# Documents that are edited with their neighbours meet in ranges of about this many rows, or of more
# where there would be more than `CELLS` ranges.
RANGE_ROWS = 2_000
CELLS = 1 << 16
STEP = 256  # borders that are looked through at once
RANGE = ["_bucket", "_part", "_copy"]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def _sorted_hashes(words: str) -> Column:
    """Hashes of all runs of five words, ascending."""
    count = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(0), count - SHINGLE_WORDS),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]),
    )
    short = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.sort_array(F.when(count >= SHINGLE_WORDS, runs).otherwise(short))


def _bin(value: Column) -> Column:
    """0 to 255, ascending with the value."""
    return (F.shiftright(value, 56) + BINS // 2).cast("int")


def _minima(hashes: str) -> Column:
    """The smallest hash of each filled bin; bins are runs of the sorted hashes."""
    return F.filter(hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1))))


def _spread(minima: str) -> Column:
    """All bins in order, NULL where a bin is empty."""
    nothing = F.lit(None).cast("long")
    placed = F.transform(
        minima,
        lambda h, i: F.concat(
            F.array_repeat(
                nothing,
                F.when(i == 0, _bin(h)).otherwise(_bin(h) - _bin(F.get(minima, i - 1)) - 1),
            ),
            F.array(h),
        ),
    )
    rest = BINS - 1 - _bin(F.element_at(minima, -1))
    return F.concat(F.flatten(placed), F.array_repeat(nothing, rest))


def _densified(bins: str, minima: str) -> Column:
    """Every bin filled."""

    def value(place: Column) -> Column:
        tries = [F.get(bins, place)]
        for turn in range(PROBES):
            tries.append(F.get(bins, F.pmod(F.xxhash64(place, F.lit(turn)), F.lit(BINS)).cast("int")))
        nearest = F.array_min(
            F.transform(minima, lambda h: F.struct(F.xxhash64(place, _bin(h), F.lit("last")), h.alias("h")))
        )
        return F.coalesce(*tries, nearest["h"])

    return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)


def _digits(values: str) -> Column:
    """The low bits of each value, hashed with its place: else copies of one value would agree, or
    differ, with another text's copies all at once."""
    low = F.transform(
        values,
        lambda v, i: F.substring(
            F.lit("0123456789abcdef"), F.xxhash64(v, i).bitwiseAND(15).cast("int") + 1, 1
        ),
    )
    return F.array_join(low, "")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the column `name`; names with two leading underscores are used meanwhile."""
    kept = [F.col(f"`{c}`") for c in df.columns]
    step = df.select(*kept, _words(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__words"))
    step = step.select(*kept, _sorted_hashes("__words").alias("__hashes"))
    step = step.select(*kept, _minima("__hashes").alias("__minima"))
    step = step.select(*kept, "__minima", _spread("__minima").alias("__bins"))
    step = step.select(*kept, _densified("__bins", "__minima").alias("__full"))
    return step.select(*kept, _digits("__full").alias(name))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints, corrected for digits equal by chance."""
    equal = F.size(
        F.filter(
            F.sequence(F.lit(1), F.lit(BINS)),
            lambda i: F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1)),
        )
    )
    return F.greatest((equal / BINS - CHANCE) / (1 - CHANCE), F.lit(0.0))


def _borders(docs: DataFrame, ranges: int) -> list[int]:
    """Ids that cut the rows into parts of about one size. One that would be a border twice, being that of very
    many rows, gets a part of its own: it and the id behind it are borders."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, max(10 * ranges, 10_000))).first()[0] or []
    hot = {a + 1 for a, b in zip(found, found[1:], strict=False) if a == b and a < (1 << 63) - 1}
    return sorted({*found, *hot})


def _bucket(docs: DataFrame, borders: list[int]) -> DataFrame:
    """`docs` with `_bucket`: ascending with doc_id, -1 for NULL. Two steps of a few hundred comparisons."""
    fine = [borders[i : i + STEP] for i in range(0, len(borders), STEP)]
    table = [(0, []), *enumerate(fine, 1)]
    steps = docs.sparkSession.createDataFrame(table, "_coarse int, _fine array<long>")
    coarse = F.array(*[F.lit(part[0]) for part in fine]).cast("array<long>")
    found = docs.withColumn("_coarse", F.size(F.filter(coarse, lambda b: b <= F.col("doc_id"))))
    found = found.join(F.broadcast(steps), "_coarse")
    behind = F.size(F.filter("_fine", lambda b: b <= F.col("doc_id")))
    number = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("_coarse") * (STEP + 1) + behind)
    return found.withColumn("_bucket", number).drop("_coarse", "_fine")


def _split(docs: DataFrame, by: list[str], rows: int, name: str, place: Column) -> DataFrame:
    """`docs` with `name`: parts of a group that holds one id, or NULL, and far more than `rows` rows."""
    counts = docs.groupBy(*by).agg(F.count("*").alias("n"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    heavy = counts.where((F.col("n") > 2 * rows) & F.col("a").eqNullSafe(F.col("b"))).collect()
    if not heavy:
        return docs.withColumn(name, F.lit(0))
    table = [(*[r[c] for c in by], -(-r["n"] // rows)) for r in heavy]
    sizes = docs.sparkSession.createDataFrame(table, ", ".join(f"{c} int" for c in by) + ", _parts int")
    joined = docs.join(F.broadcast(sizes), by, "left")
    part = F.coalesce(F.pmod(place, F.col("_parts")), F.lit(0)).cast("int")
    return joined.withColumn(name, part).drop("_parts")


def _with_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` with `RANGE`, and for each range its largest id and the range it comes down from.

    Borders are quantiles of the ids, so far ids make no large range. Rows of one hot id, or of NULL, are dealt to parts
    by their text, and equal rows that outweigh a part by their place in the table. The driver sees a row per
    range, of which there are little more than `CELLS`.
    """
    total = docs.count()
    rows = max(RANGE_ROWS, -(-total // CELLS))
    ranged = _bucket(docs.withColumn("_place", F.monotonically_increasing_id()), _borders(docs, -(-total // rows)))
    ranged = _split(ranged, RANGE[:1], rows, RANGE[1], F.xxhash64("text"))
    ranged = _split(ranged, RANGE[:2], rows, RANGE[2], F.xxhash64("_place")).drop("_place")
    tops = {tuple(r[c] for c in RANGE): r["top"] for r in ranged.groupBy(*RANGE).agg(F.max("doc_id").alias("top")).collect()}
    # the first row of a range follows the last one of the range above, the very first the very last
    order = sorted(tops, key=lambda at: (-at[0], *at[1:]))
    above = [(*at, *order[i - 1], tops[at]) for i, at in enumerate(order)]
    names = [*RANGE, *[f"{c}_above" for c in RANGE]]
    return ranged, docs.sparkSession.createDataFrame(above, ", ".join(f"{c} int" for c in names) + ", top long")


def edited_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its text with the end replaced by its neighbour's start.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The
    neighbour is the next document in descending doc_id, the first one after the last;
    rows of one id are ordered by text, those of an id with thousands of rows by a hash of it first. Documents of a range
    meet in one window, and the first row of the range that follows is added to it, so that no window spans the table. An
    empty table gives an empty result; only `doc_id` and `text` are read, so other columns cannot clash. Pass a
    written table: rows that are equal may be told apart by their place in it.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if docs.isEmpty():
        ranged, tops = docs.withColumns({c: F.lit(0) for c in RANGE}), None
    else:
        ranged, tops = _with_ranges(docs)
    own = with_fingerprint(ranged, "text", "fingerprint").withColumn("_added", F.lit(False))
    if tops is not None:
        # one row per range; the rows of a range's largest id come down to the first by text
        match = ranged["doc_id"].eqNullSafe(tops["top"])
        for c in RANGE:
            match = match & (ranged[c] == tops[c])
        above = [F.col(f"{c}_above").alias(c) for c in RANGE]
        firsts = ranged.join(F.broadcast(tops), match).select(*above, ranged["doc_id"], "text")
        firsts = firsts.groupBy(*RANGE, "doc_id").agg(F.min("text").alias("text"))
        firsts = materialize(with_fingerprint(firsts, "text", "fingerprint"), "firsts")
        own = own.unionByName(firsts.withColumn("_added", F.lit(True)))
    window = f"over (partition by {', '.join(RANGE)} order by _added, doc_id desc nulls last, text)"
    paired = own.selectExpr(
        "doc_id", "text", "fingerprint", "_added",
        f"lead(text) {window} as next_text",
        f"lead(fingerprint) {window} as next_fingerprint",
    ).where("not _added")
    cut = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut)
    )
    changed = paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "fingerprint",
        "next_fingerprint",
        edited.alias("edited"),
    )
    both = with_fingerprint(changed, "edited", "edited_fingerprint")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
