"""Vocabulary and fixed-length encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinarium.operators.frames import items
from opinarium.operators.indexing import with_row_index
from opinarium.runtime import broadcast_if_small

# Reserved ids.
PAD, UNKNOWN, START, END = 0, 1, 2, 3
RESERVED = 4


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """Occurrences of each token; combines before the shuffle."""
    return items(df, [], tokens, "token").groupBy("token").agg(F.count("*").alias("occurrences"))


def build_vocabulary(df: DataFrame, tokens: Column) -> DataFrame:
    """(token, occurrences, id): most frequent first, ties by token, after the reserved ids."""
    counted = token_counts(df, tokens)
    ranked = with_row_index(counted, [F.col("occurrences").desc(), F.col("token")], "_rank")
    return ranked.select("token", "occurrences", (F.col("_rank") + RESERVED).alias("id"))


def look_up(df: DataFrame, vocabulary: DataFrame, tokens: list[str], key: str) -> DataFrame:
    """(key, one list of ids per token column), in token order; unlisted tokens are unknown.

    Rows stay also when every list is empty. Pass lists already cut to length. Keys must be
    unique: two rows of one key raise instead of being merged.
    """

    def placed(side: int, column: str) -> Column:
        return F.transform(
            F.col(column),
            lambda t, i: F.struct(F.lit(side).alias("side"), i.alias("pos"), t.alias("token")),
        )

    spread = F.array(*[placed(n, c) for n, c in enumerate(tokens)])
    rows = df.select(key, F.explode_outer(F.flatten(spread)).alias("_t")).select(
        key, "_t", F.col("_t.token").alias("_token")
    )
    ids = broadcast_if_small(
        vocabulary.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    )
    known = rows.join(ids, "_token", "left").select(
        key,
        F.col("_t.side").alias("_side"),
        F.struct(
            F.col("_t.pos").alias("pos"),
            F.coalesce(F.col("_id").cast("int"), F.lit(UNKNOWN)).alias("id"),
        ).alias("_t"),
    )
    # collect_list skips NULL, so each side gathers its own tokens only
    gathered = known.groupBy(key).agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("_side") == n, F.col("_t")))).alias(c)
            for n, c in enumerate(tokens)
        ]
    )

    def ids_of(column: str) -> Column:
        places = F.transform(column, lambda t: t["pos"])
        return F.when(
            F.size(places) == F.size(F.array_distinct(places)), F.transform(column, lambda t: t["id"])
        ).otherwise(F.raise_error(F.lit("two rows have one key")))

    return gathered.select(key, *[ids_of(c).alias(c) for c in tokens])


def _padded(values: Column, length: Column, max_len: int, pad: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(pad), F.lit(max_len) - length))


def encode(
    df: DataFrame, vocabulary: DataFrame, tokens: Column, key: str, max_len: int
) -> DataFrame:
    """(key, input_ids, attention_mask), both of length `max_len`.

    Start mark, at most `max_len - 2` ids, end mark, padding; the mask is 1 up to the
    end mark. Tokens come as an array column, so pre-split words work as well.
    """
    cut = df.select(key, F.slice(tokens, 1, max_len - 2).alias("_ids"))
    found = look_up(cut, vocabulary, ["_ids"], key)
    size = F.size("_ids") + 2
    ids = F.concat(F.array(F.lit(START)), F.col("_ids"), F.array(F.lit(END)))
    mask = F.array_repeat(F.lit(1), size)
    return found.select(
        key,
        _padded(ids, size, max_len, PAD).alias("input_ids"),
        _padded(mask, size, max_len, 0).alias("attention_mask"),
    )


def pair_lengths(a: Column, b: Column, room: int) -> tuple[Column, Column]:
    """Lengths of both sides after cutting the longer side first, one token at a time.

    On equal lengths the second side gives way.
    """
    half_up, half = (room + 1) // 2, room // 2
    fits = a + b <= room
    keep_a = (
        F.when(fits, a)
        .when(b <= half, F.lit(room) - b)
        .when(a <= half_up, a)
        .otherwise(F.lit(half_up))
    )
    return keep_a, F.when(fits, b).otherwise(F.lit(room) - keep_a)


def token_spans(text: Column, tokens: Column) -> Column:
    """Start and end of each token in its text; every search goes on behind the last token."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(spans: Column, token: Column) -> Column:
        behind = F.coalesce(F.try_element_at(spans, F.lit(-1))["end"], F.lit(0))
        start = F.call_function("locate", token, text, behind + 1) - 1
        return F.concat(
            spans,
            F.array(
                F.struct(start.alias("start"), (start + F.length(token)).alias("end"))
            ),
        )

    return F.aggregate(tokens, empty, step)


def encode_pair(
    df: DataFrame,
    vocabulary: DataFrame,
    first: tuple[Column, Column],
    second: tuple[Column, Column],
    key: str,
    max_len: int,
) -> DataFrame:
    """`[start] A [end] B [end]` with segment ids, mask and character spans.

    `first` and `second` are (cleaned text, tokens). The longer side is cut first. Marks
    and padding have segment 0 outside the second part, and the span (0, 0).
    """
    (text_a, tokens_a), (text_b, tokens_b) = first, second
    sides = df.select(
        key, text_a.alias("_ta"), tokens_a.alias("_a"), text_b.alias("_tb"), tokens_b.alias("_b")
    )
    keep_a, keep_b = pair_lengths(F.size("_a"), F.size("_b"), max_len - 3)
    sides = sides.withColumns({"_na": keep_a, "_nb": keep_b}).select(
        key,
        "_ta",
        "_tb",
        F.slice("_a", F.lit(1), F.col("_na")).alias("_a"),
        F.slice("_b", F.lit(1), F.col("_nb")).alias("_b"),
    )
    spans = sides.select(
        key,
        token_spans(F.col("_ta"), F.col("_a")).alias("_sa"),
        token_spans(F.col("_tb"), F.col("_b")).alias("_sb"),
    )
    found = look_up(sides, vocabulary, ["_a", "_b"], key).join(spans, key)
    size_a, size_b = F.size("_a") + 2, F.size("_b") + 1
    size = size_a + size_b
    start, end = F.array(F.lit(START)), F.array(F.lit(END))
    nowhere = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")))
    offsets = F.concat(nowhere, F.col("_sa"), nowhere, F.col("_sb"), nowhere)
    return found.select(
        key,
        _padded(F.concat(start, F.col("_a"), end, F.col("_b"), end), size, max_len, PAD).alias(
            "input_ids"
        ),
        _padded(
            F.concat(F.array_repeat(F.lit(0), size_a), F.array_repeat(F.lit(1), size_b)),
            size,
            max_len,
            0,
        ).alias("segment_ids"),
        _padded(F.array_repeat(F.lit(1), size), size, max_len, 0).alias("attention_mask"),
        F.concat(offsets, F.flatten(F.array_repeat(nowhere, F.lit(max_len) - size))).alias(
            "offsets"
        ),
    )
