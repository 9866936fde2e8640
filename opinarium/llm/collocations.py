"""Phrases whose words belong together, by mergeable frequency summaries and an exact second pass.

A phrase can only be frequent if the shorter phrases in it are. So lengths are searched in turn: for
each, tasks count the phrases made of surviving shorter ones by a hash, deal the counts to hash partitions, and each
partition merges them into a Misra-Gries summary. A summary of more than mass / threshold counters, mass
being the occurrences dealt to its partition, undercounts by less than the threshold: every frequent phrase is still in it. It has
several times as many, so that the undercount, which it keeps, is small, and a counter that stays below the threshold with
it goes. What is left forms a bitmap of fixed size. Hashes that collide, and bits that do, only let more phrases through: the
second pass counts whatever the bitmap lets through by its text, exactly, and keeps what reaches the threshold.

Counts and scores: see `collocations`. Each step reads whole texts; its memory is bounded by the buffer of a few MB of text, by
the counters of a partition, whose number grows with the table, and by the bitmap.

NULL and empty texts hold no words; a NULL language is `und`. Repeated rows count each. An empty table
gives an empty result. Only `text` and `lang` are read, so other columns cannot clash. Very long texts are cut between
pieces when a buffer is full; a piece is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from opinarium.llm.common import batches_of
from opinarium.runtime import materialize, run_folder

LONGEST = 4
THRESHOLD = 30
TOP = 2000
COVERED = 80  # hundredths of a phrase's count at which a longer one replaces it
SCALE = 2_000_000

BUFFER = 1 << 19  # bytes of text that are counted together
ROWS = 512  # of texts that go to a worker at once
KEPT = 1 << 20  # phrases whose counts a task holds before it passes them on
BITS = 1 << 27  # of the bitmap: 16 MB
PART_BYTES = 4 << 20  # of text for each hash partition
ROOM = 4  # counters of a summary, in multiples of mass / threshold
KEY_BYTES = 5  # of a hash, behind the bits that name its partition

WORD, BLANK, END = 0, 1, 2
SEED = np.uint64(0x9E3779B97F4A7C15)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(byte in lower case, kind of byte): A-Z only; other letters are left as they are."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.full(256, WORD, np.uint8)
    kind[[0x20, 0x09]] = BLANK
    kind[[*b".,;:!?", *range(0x0A, 0x0E)]] = END
    return lower, kind


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _within(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each stretch, one behind the other."""
    firsts = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - firsts, sizes)


class Words:
    """The words of a buffer of texts, as places in `clean`, where each is followed by one blank."""

    def __init__(self, buffer: np.ndarray, text_ends: np.ndarray, langs: np.ndarray, seeds: np.ndarray):
        """`langs[i]` is the language of text i, which ends before `text_ends[i]`; `seeds` of languages."""
        lower, kind = _tables()
        kinds = kind[buffer]
        is_word = np.concatenate([[False], kinds == WORD, [False]])
        edges = np.flatnonzero(is_word[1:] != is_word[:-1])
        starts, ends = edges[::2], edges[1::2]
        # a text ends in a byte that ends a piece, see `buffers`
        self.piece = np.cumsum(kinds == END, dtype=np.int32)[starts] if len(starts) else starts
        self.lang = langs[np.searchsorted(text_ends, starts, side="right")]
        sizes = ends - starts
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes
        self.clean = np.full(int((sizes + 1).sum()), 0x20, np.uint8)
        at = _within(self.starts, sizes)
        self.clean[at] = lower[buffer[_within(starts, sizes)]]
        self.hash = self._hashes(at, sizes, seeds)

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self, at: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.empty(0, np.uint64)
        offset = at - np.repeat(self.starts, sizes)
        powers = np.cumprod(np.full(int(sizes.max()), SEED | np.uint64(1)))
        summed = np.add.reduceat((self.clean[at].astype(np.uint64) + np.uint64(1)) * powers[offset], np.cumsum(sizes) - sizes)
        return _mixed(summed ^ seeds[self.lang])

    def numbers(self) -> np.ndarray:
        """For each word a number of its text and language within the buffer; equal exactly if these are."""
        sizes = self.ends - self.starts
        at = _within(self.starts, sizes)
        _, first, same = np.unique(self.hash, return_index=True, return_inverse=True)
        model = first[same]
        # words of one hash are compared byte by byte with the first of them
        equal = (sizes == sizes[model]) & (self.lang == self.lang[model])
        if equal.all():
            theirs = self.clean[_within(self.starts[model], sizes)]
            if (self.clean[at] == theirs).all():
                return same
        named: dict[tuple[int, bytes], int] = {}
        spans = zip(self.lang.tolist(), self.starts.tolist(), self.ends.tolist(), strict=True)
        return np.array([named.setdefault((g, self.clean[a:b].tobytes()), len(named)) for g, a, b in spans], np.int64)


def buffers(batches: Iterator[pa.RecordBatch], size: int = BUFFER) -> Iterator[tuple[Words, list[str]]]:
    """Words of about `size` bytes of text at a time, and the languages their numbers stand for."""
    lower, kind = _tables()
    end = np.flatnonzero(kind == END)[0].astype(np.uint8)
    names: list[str] = []
    number: dict[str, int] = {}
    parts: list[np.ndarray] = []
    langs: list[int] = []
    held = 0

    def words() -> Words:
        seeds = np.array([_seed(name) for name in names], np.uint64)
        ends = np.cumsum([len(part) + 1 for part in parts])
        buffer = np.concatenate([x for part in parts for x in (part, [end])]).astype(np.uint8)
        return Words(buffer, ends, np.array(langs), seeds)

    for batch in batches:
        texts = batch.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        for i, lang in enumerate(batch.column(1).to_pylist()):
            if not valid[i]:
                continue
            if lang not in number:
                number[lang] = len(names)
                names.append(lang)
            text = data[offsets[i] : offsets[i + 1]]
            while len(text):
                take = len(text)
                if take > size:  # behind the last end of a piece, or the next one
                    stops = np.flatnonzero(kind[text] == END)
                    before = stops[: np.searchsorted(stops, size)]
                    take = int(before[-1] if len(before) else stops[0] if len(stops) else take - 1) + 1
                parts.append(text[:take].copy())
                langs.append(number[lang])
                held, text = held + take + 1, text[take:]
                if held >= size:
                    yield words(), names
                    parts, langs, held = [], [], 0
    if parts:
        yield words(), names


def _seed(lang: str) -> int:
    """A number for a language: equal in all tasks."""
    import zlib

    data = lang.encode()
    return zlib.crc32(data) << 32 | zlib.crc32(data[::-1])


def phrases(words: Words, longest: int, passes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, place of the first word, hash) of the phrases of each length that `passes` lets through.

    A phrase lies within a piece, and both phrases one word shorter in it were let through.
    """
    at = np.arange(len(words))
    hashes = words.hash
    for length in range(1, longest + 1):
        if length > 1:
            # neighbours in `at` are neighbours in the text
            follows = np.flatnonzero(at[1:] == at[:-1] + 1)
            follows = follows[words.piece[at[follows]] == words.piece[at[follows] + length - 1]]
            hashes = _mixed(hashes[follows] * SEED + words.hash[at[follows] + length - 1] + np.uint64(length))
            at = at[follows]
        kept = passes(length, hashes)
        if kept is not None:
            at, hashes = at[kept], hashes[kept]
        yield length, at, hashes


def _keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bytes of hashes that are kept, behind the bits that name the partition."""
    return (hashes << np.uint64(bits)) >> np.uint64(64 - 8 * KEY_BYTES)


def _passes(bitmap: np.ndarray | None, known: int, bits: int):
    """Lets through what the bitmap holds, for the lengths it was made for; all of the next length."""

    def passes(length: int, hashes: np.ndarray) -> np.ndarray | None:
        if length > known:
            return None
        place = _keys(hashes, bits) & np.uint64(BITS - 1)
        return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0

    return passes


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def merge_summaries(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One Misra-Gries summary of `capacity` counters from the counters of several, and what was taken off them.

    Sums equal keys; if too many are left, the count of the largest that must go is taken off all. Each unit taken off
    takes capacity + 1 occurrences away, so over any merges a key loses mass / (capacity + 1) at most.
    """
    keys, counts = _summed(keys, counts)
    if len(keys) <= capacity:
        return keys, counts, 0
    less = int(np.partition(counts, -capacity - 1)[-capacity - 1])
    counts = counts - less
    return keys[counts > 0], counts[counts > 0], less


PARTS = "part int, mass long, n int, hashes binary, counts binary"
PARTS_SCHEMA = pa.schema(
    [("part", pa.int32()), ("mass", pa.int64()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
)


def _width(counts: np.ndarray) -> str:
    return "<u1" if counts.max() < 1 << 8 else "<i4" if counts.max() < 1 << 31 else "<i8"


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of a row."""
    keys = np.zeros((row["n"], 8), np.uint8)
    keys[:, :KEY_BYTES] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, KEY_BYTES)
    width = {1: "<u1", 4: "<i4", 8: "<i8"}[len(row["counts"]) // row["n"]]
    return keys.view("<u8").ravel(), np.frombuffer(row["counts"], width).astype(np.int64)


def _part_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _counted(texts: DataFrame, length: int, bits: int, bitmap: Broadcast | None) -> DataFrame:
    """Counts of the phrases of one length by hash, packed by hash partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = _passes(bitmap and np.frombuffer(bitmap.value, np.uint8), length - 1, bits)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for words, _ in buffers(batches):
            for n, _, hashes in phrases(words, length, passes):
                if n == length and len(hashes):
                    held.append(_summed(hashes, np.ones(len(hashes), np.int64)))
                    size += len(held[-1][0])
            if size > KEPT:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > KEPT // 2:
                    yield from dealt(*held[0])
                    held, size = [], 0
        if held:
            yield from dealt(*_summed(*map(np.concatenate, zip(*held, strict=True))))

    def dealt(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        # ascending hashes lie together by partition, which their first bits name
        parts, first = np.unique(_part_of(hashes, bits), return_index=True)
        bounds = np.append(first, len(hashes))
        keys = _keys(hashes, bits).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        rows = [
            {"part": int(p), "mass": int(counts[a:b].sum()), "n": b - a, "hashes": keys[a:b].tobytes(),
             "counts": counts[a:b].astype(_width(counts[a:b])).tobytes()}
            for p, a, b in zip(parts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        for some in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[some : some + 256], schema=PARTS_SCHEMA)

    return texts.mapInArrow(run, PARTS)


def _survivors(counted: DataFrame, threshold: int) -> DataFrame:
    """(place): the bits, from 1, of all hashes that are left in the summaries of the partitions."""
    masses = F.broadcast(counted.groupBy("part").agg(F.sum("mass").alias("_mass")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries: dict[int, list] = {}
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                one = summaries.setdefault(row["part"], [np.empty(0, np.uint64), np.empty(0, np.int64), 0, 0])
                one[:2] = (np.concatenate(both) for both in zip(one[:2], _unpacked(row), strict=True))
                one[3] = ROOM * (row["_mass"] // threshold + 1)
                # merged when twice as many as may stay have come together
                if len(one[0]) > 2 * one[3] + 4096:
                    *one[:2], less = merge_summaries(one[0], one[1], one[3])
                    one[2] += less
        for keys, counts, lost, capacity in summaries.values():
            keys, counts, less = merge_summaries(keys, counts, capacity)
            keys = keys[counts + lost + less >= threshold]
            yield pa.record_batch([pa.array((keys & np.uint64(BITS - 1)).astype(np.int64) + 1)], names=["place"])

    return counted.join(masses, "part").repartition("part").mapInArrow(run, "place long")


def _bitmap(survivors: DataFrame) -> bytes:
    """One bit per place. The driver holds BITS / 8 bytes, however many there are."""
    bits = np.zeros(BITS // 8, np.uint8)
    built = survivors.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    for bucket, some in built.collect():
        at = (bucket - 1) * 4096
        bits[at : at + len(some)] = np.frombuffer(some, np.uint8)
    return bits.tobytes()


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, phrase, words, a): all phrases of up to `longest` words that occur `threshold` times or more
    in texts of a language; and a row with NULL phrase per language, words 0, a all its words. Written."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((size // PART_BYTES).bit_length(), 4), 20)
    merged, bitmap = np.zeros(BITS // 8, np.uint8), None
    with run_folder(spark, "phrases"):
        for length in range(1, longest + 1):
            with batches_of(spark, ROWS):
                counted = materialize(_counted(texts, length, bits, bitmap), f"phrases-{length}")
            with batches_of(spark, 64):
                merged |= np.frombuffer(_bitmap(_survivors(counted, threshold)), np.uint8)
            bitmap = spark.sparkContext.broadcast(merged.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = _passes(np.frombuffer(bitmap.value, np.uint8), longest, bits)
        for words, names in buffers(batches):
            yield _rows([(lang, None, 0, n) for lang, n in enumerate(np.bincount(words.lang).tolist()) if n], names)
            # numbers of equal phrases: by the number of the phrase but its last word, and of that
            number, same_word = np.zeros(len(words) + 1, np.int64), words.numbers()
            count = int(same_word.max(initial=0)) + 1
            for n, at, _ in phrases(words, longest, passes):
                keys = number[at] * count + same_word[at + n - 1]
                _, first, same, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                number[at] = same
                yield _texts(words, n, at[first], times, names)

    schema = "lang string, phrase string, words int, a long"
    counted = texts.mapInArrow(run, schema).groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))
    with batches_of(spark, ROWS):
        return materialize(counted.where((F.col("a") >= threshold) | (F.col("words") == 0)), "frequent")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    lang, phrase, n, a = zip(*rows, strict=True) if rows else ((), (), (), ())
    columns = [pa.array([names[i] for i in lang], pa.string()), pa.array(phrase, pa.string()), pa.array(n, pa.int32()), pa.array(a, pa.int64())]
    return pa.record_batch(columns, names=["lang", "phrase", "words", "a"])


def _texts(words: Words, n: int, at: np.ndarray, times: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """A row per phrase: its words and the blanks between them lie together in `clean`."""
    starts, sizes = words.starts[at], words.ends[at + n - 1] - words.starts[at]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = words.clean[_within(starts, sizes)]
    phrase = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    lang = pa.DictionaryArray.from_arrays(pa.array(words.lang[at], pa.int32()), pa.array(names, pa.string())).cast(pa.string())
    columns = [lang, phrase, pa.array(np.full(len(at), n), pa.int32()), pa.array(times, pa.int64())]
    return pa.record_batch(columns, names=["lang", "phrase", "words", "a"])


def _exact(column: str | int) -> Column:
    """As a number whose products do not overflow."""
    value = F.lit(column) if isinstance(column, int) else F.col(column)
    return value.cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    threshold: int = THRESHOLD,
    top: int = TOP,
    covered: int = COVERED,
    scale: int = SCALE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    Words are lower-cased (A-Z) runs without blank or tabulator in the pieces between `.,;:!?` and line ends. A
    phrase of two words or more that occurs `threshold` times is a candidate. Cut after k words its score is
    floor(scale * a / (l + r)), of the counts of the whole and both parts; the cut of the lowest score
    counts, of equal ones the first. A candidate goes if a longer one holds its words and occurs `covered`
    hundredths as often.
    """
    found = frequent_phrases(docs, longest, threshold)
    phrases_ = found.where("words > 0").select("lang", "phrase", "words", "a")
    totals = found.where("words = 0").select("lang", F.col("a").alias("n"))
    candidates = phrases_.where("words > 1")

    # parts of a frequent phrase are frequent, so both joins find all
    parted = F.split("phrase", " ")
    cut = candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(parted, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(parted, F.col("k") + 1, F.size(parted)), " ").alias("rest"),
    )
    firsts = phrases_.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rests = phrases_.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = cut.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    scored = scored.withColumn("_both", _exact("l") + _exact("r")).withColumn("_times", _exact(scale) * _exact("a"))
    best = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr("_times div _both").alias("score"), "k", "l", "r")).alias("best")
    )
    best = best.select("lang", "phrase", "a", "best.*").drop("k")

    inner = candidates.where("words > 2").select(
        "lang",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, words - 1), s -> transform(sequence(1, words - s + 1),"
                " i -> array_join(slice(split(phrase, ' '), i, s), ' '))))"
            )
        ).alias("phrase"),
        F.col("a").alias("longer"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    best = best.join(inner, ["lang", "phrase"], "left")
    replaced = _exact(100) * _exact("longer") >= _exact(covered) * _exact("a")
    best = best.where(~F.coalesce(replaced, F.lit(False)))

    # a language is ranked in parts first, so that one that holds all rows is not one task's
    order = [F.desc("score"), F.desc("a"), "phrase"]
    best = best.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for by in (["lang", "_part"], ["lang"]):
        best = best.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
        best = best.where(F.col("rank") <= top)
    best = best.join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
