"""Keyword rules: a sheet of keyword cells as data, matched against texts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from opinarium.functions import fixed_values as fixed
from opinarium.operators.frames import items
from opinarium.runtime import materialize

# Bytes a clause is looked up by, at most; bits of the bitmap that tells a dictionary's beginnings, as a power
# of two; bytes of text that are searched at once.
GRAM = 8
BITMAP_BITS = 23
PASS = 1 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)

# The ways to match: a join on grams, for a dictionary of any size, or conditions in the query.
GRAMS, CONDITIONS = "grams", "conditions"


def compile_rules(sheet: DataFrame) -> DataFrame:
    """(rule_order, name, clauses) from a keyword sheet.

    Each filled cell is a clause, `+` joins terms that must all occur, clauses
    are alternatives. A repeated name keeps its first position and its last rule.
    Rows without keywords make no rule. An empty piece, as in `a++b`, occurs
    in every text.
    """
    cells = F.filter(
        F.array(*[F.coalesce(F.col(c), F.lit("")) for c in fixed.SHEET_KEYWORD_COLUMNS]),
        lambda cell: cell != "",
    )
    clauses = F.transform(cells, lambda cell: F.split(cell, r"\+", -1))
    rules = sheet.select("row_order", F.col(fixed.SHEET_NAME_COLUMN).alias("name"), clauses.alias("clauses"))
    return (
        rules.where(F.size("clauses") > 0)
        .groupBy("name")
        .agg(
            F.min("row_order").alias("rule_order"),
            F.max_by("clauses", "row_order").alias("clauses"),
        )
        .select("rule_order", "name", "clauses")
    )


def _listed(rules: DataFrame) -> list[Row]:
    return rules.orderBy("rule_order").collect()


def hits_by_condition(df: DataFrame, rules: DataFrame, text: str = "text") -> DataFrame:
    """Add the list `hits` by conditions compiled into the query.

    For the handful of rules that a caller writes down: the rules come to the driver, and the
    query grows with them. No join and no shuffle.
    """
    column = F.col(text)

    def clause(terms: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.contains(column, F.lit(t)) for t in set(terms)])

    def rule(clauses: list[list[str]]) -> Column:
        return reduce(lambda a, b: a | b, [clause(c) for c in clauses])

    names = [F.when(rule(r["clauses"]), F.lit(r["name"])) for r in _listed(rules)]
    if not names:
        return df.withColumn("hits", F.array().cast("array<string>"))
    return df.withColumn("hits", F.array_compact(F.array(*names)))


def _longest_first(terms: Column) -> Column:
    def shorter(a: Column, b: Column) -> Column:
        return F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(
            a > b, 1
        ).otherwise(0)

    return F.array_sort(F.array_distinct(terms), shorter)


def _bits(grams: np.ndarray) -> np.ndarray:
    """The bit of each gram in the dictionary's bitmap."""
    return ((grams * SPREAD) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _gram_at(data: np.ndarray, length: int) -> np.ndarray:
    """The bytes of every stretch of a length as one number; shorter stretches bear their length on top."""
    count = max(len(data) - length + 1, 0)
    found = np.zeros(count, np.uint64)
    for k in range(length):
        found |= data[k : k + count].astype(np.uint64) << np.uint64(8 * k)
    return found | np.uint64(length << 56) if length < GRAM else found


def _first_gram(term: Column) -> Column:
    """(gram, length, bit): the beginning of a term, its bytes, and its place in the bitmap, from 1."""

    def found(terms: pd.Series) -> pd.DataFrame:
        heads = [np.frombuffer(t.encode()[:GRAM], np.uint8) for t in terms]
        grams = np.array([_gram_at(head, len(head))[0] if len(head) else 0 for head in heads], np.uint64)
        return pd.DataFrame({"gram": grams.view(np.int64), "length": list(map(len, heads)), "bit": _bits(grams) + 1})

    return F.pandas_udf(found, "gram long, length int, bit long")(term)


def _clauses_by_gram(rules: DataFrame) -> DataFrame:
    """(gram, length, bit, clauses): clauses as (rule_order, name, terms) by the beginning of their longest term."""
    clauses = rules.select("rule_order", "name", F.explode("clauses").alias("terms"))
    clauses = clauses.withColumn("terms", _longest_first(F.col("terms")))
    marked = clauses.withColumn("_g", _first_gram(F.get("terms", F.lit(0))))
    listed = F.collect_set(F.struct("rule_order", "name", "terms"))
    return marked.groupBy("_g").agg(listed.alias("clauses")).select("_g.*", "clauses")


def _known_grams(lengths: Sequence[int], bitmap: bytes):
    """Column function: the distinct grams of a text that the dictionary may have. One pass over its bytes per length."""

    def found(batch: pa.Array) -> pa.Array:
        known = np.frombuffer(bitmap, np.uint8)
        texts = batch.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        stops = offsets - offsets[0]
        rows, grams = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for start in range(0, len(data), PASS):
            # the next pass goes on where a gram can still begin
            some = data[start : start + PASS + GRAM - 1]
            for length in lengths:
                values = _gram_at(some, length)[:PASS] if length else np.empty(0, np.uint64)
                bits = _bits(values)
                at = np.flatnonzero(known[bits >> 3] >> (bits & 7).astype(np.uint8) & 1)
                row = np.searchsorted(stops, at + start, side="right") - 1
                within = at + start + length <= stops[row + 1]
                rows.append(row[within])
                grams.append(values[at][within])
        if 0 in lengths:
            rows.append(np.arange(len(texts)))
            grams.append(np.zeros(len(texts), np.uint64))
        row, gram = np.concatenate(rows), np.concatenate(grams).view(np.int64)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        counts = np.bincount(row[new], minlength=len(texts))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(gram[new]))

    return F.arrow_udf(found, "array<long>")


def hits_by_grams(
    df: DataFrame, rules: DataFrame, text: str = "text", key: str | None = None
) -> DataFrame:
    """Add the list `hits` for a dictionary and texts of any size.

    A clause is looked up by the beginning of its longest term, `GRAM` bytes at most. Texts are searched
    for the beginnings by a bitmap of the dictionary, which has a fixed size, and only what is
    found there is spread out, next to an id, and meets the clauses in an equi-join. The clauses met
    are gathered by id and checked in the text, where they are joined to it. Rows that are spread out hold ids and
    grams, never a text. The id is `key`, a column that identifies the text, or a 128-bit hash of it. An empty
    term occurs in every text; a NULL text has no hits.
    """
    none = F.array().cast("array<string>")
    clauses = materialize(_clauses_by_gram(rules), "clauses")
    lengths = sorted(r[0] for r in clauses.select("length").distinct().collect())  # 0 to GRAM
    if not lengths:
        return df.withColumn("hits", none)
    bitmap = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    built = clauses.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    for bucket, bits in built.collect():
        bitmap[(bucket - 1) * len(bits) :][: len(bits)] = np.frombuffer(bits, np.uint8)
    grams = _known_grams(lengths, bitmap.tobytes())
    number = F.col(key) if key else F.unhex(F.md5(F.col(text).cast("binary")))
    named = df.select(number.alias("_id"), F.col(text).alias("_text")).where("_text is not null")
    met = (
        items(named, ["_id"], grams("_text"), "gram")
        .distinct()
        .join(clauses.select("gram", "clauses"), "gram")
        .groupBy("_id")
        .agg(F.flatten(F.collect_list("clauses")).alias("_met"))
    )
    held = F.filter("_met", lambda c: F.forall(c["terms"], lambda term: F.contains(F.col(text), term)))
    rules_held = F.transform(held, lambda c: F.struct(c["rule_order"].alias("o"), c["name"].alias("n")))
    ordered = F.array_sort(F.array_distinct(rules_held))
    # the sides are dealt by id, where a hot one can be split; neither is small for certain
    joined = df.withColumn("_id", number).join(met.hint("merge"), "_id", "left")
    hits = F.coalesce(F.transform(ordered, lambda r: r["n"]), none)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], hits.alias("hits"))


def find_hits(
    df: DataFrame,
    rules: DataFrame,
    text: str = "text",
    way: str = GRAMS,
    key: str | None = None,
) -> DataFrame:
    """Add `hits`: names of all matching rules, in rule order; case matters.

    The caller names the way; both give the same rows.
    """
    if way == CONDITIONS:
        return hits_by_condition(df, rules, text)
    if way == GRAMS:
        return hits_by_grams(df, rules, text, key)
    raise ValueError(f"unknown way {way!r}")


def match_rules(
    df: DataFrame,
    rules: DataFrame,
    text: str = "text",
    keep_all: bool = True,
    way: str = GRAMS,
    key: str | None = None,
) -> DataFrame:
    """Add `hits` as text, names separated by a comma; rows without a hit get "".

    `keep_all=False` drops rows without a hit and leaves `hits` a list.
    """
    tagged = find_hits(df, rules, text, way, key)
    if keep_all:
        return tagged.withColumn("hits", F.array_join("hits", ", "))
    return tagged.where(F.size("hits") > 0)
