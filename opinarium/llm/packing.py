"""Best-fit packing into token sequences, certified by lower bounds.

Each document becomes its token ids and an end id. One that is longer than a sequence is cut so that
only its first piece is shorter; full pieces are sequences of their own. The other pieces, one
per document at most, are packed in groups of bounded size by best-fit decreasing. Dual-feasible
functions give each group a lower bound for its number of sequences. Groups above their
bound release the documents of their emptiest sequences, which are dealt anew into groups
and packed again; a round is kept where it needs fewer sequences. No group grows
with the table, and no step looks at all pieces at once.

NULL and empty texts are a single end id. Repeated rows are packed as separate documents.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinarium.llm.common import ids_back, kept, texts_with_ids
from opinarium.runtime import materialize

LENGTH = 1024
END_ID = 2
GROUP_ROWS = 50_000
ROUNDS = 3
RELEASED = 0.25  # of a group's sequences, the emptiest

# ids travel as digits, see `texts_with_ids`
PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"

# Characters on which the two tokenizer libraries read their pattern alike for certain:
# printable ASCII, tabulator, line feed, and the letters of the Latin blocks.
PLAIN = r"[\t\n -~À-ÖØ-öø-ƿ]*"


def default_vocabulary() -> tuple[str, str, str]:
    """The vocabulary for `tokenizers`, the same as ranks, and the pattern that goes with the ranks."""
    import public_tokenizers

    path = public_tokenizers.path
    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Encoder:
    """Token ids of texts, as the `tokenizers` library gives them.

    Where both libraries agree for certain, on plain texts without an added token, the several times faster
    rank one is asked.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import base64
        import re

        import tiktoken

        self._vocabulary, self._full = vocabulary, None
        with open(vocabulary, encoding="utf-8") as described:
            # their strings in a text are these tokens, which the ranks do not know
            self._added = [token["content"] for token in json.load(described).get("added_tokens", [])]
        self._plain = re.compile(PLAIN)
        with open(ranks, "rb") as lines:
            pairs = (line.split() for line in lines)
            merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._fast = tiktoken.Encoding(
            "packing", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        )

    def __call__(self, text: str) -> np.ndarray:
        if self._plain.fullmatch(text) and not any(token in text for token in self._added):
            return np.asarray(self._fast.encode_to_numpy(text, disallowed_special=()), np.uint32)
        if self._full is None:
            from tokenizers import Tokenizer

            self._full = Tokenizer.from_file(self._vocabulary)
        return np.array(self._full.encode(text, add_special_tokens=False).ids, np.uint32)


def cut(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `total` tokens; only the first may be shorter."""
    first = total % length or min(total, length)
    starts = [0, *range(first, total, length)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total], strict=True)]


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str], length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): all pieces of all documents, ids as digits."""

    parts = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = kept(parts, lambda named: Encoder(*named))
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for piece, (start, size) in enumerate(cut(len(ids), length)):
                    rows.append((doc_id, piece, start, size, zlib.crc32(ids[start : start + size])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts_with_ids(docs).mapInPandas(run, PIECE)


def best_fit(lengths: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece under best-fit decreasing; ties go to the latest sequence.

    Open sequences are kept by their free space, so a piece costs the same however many are open.
    """
    sequence = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    open_by_space: list[list[int]] = [[] for _ in range(length + 1)]
    spaces = 0  # bit s is set when a sequence has s free
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            place = open_by_space[space].pop()
            if not open_by_space[space]:
                spaces &= ~(1 << space)
        else:
            space, place, used = length, used, used + 1
        sequence[i], offset[i] = place, length - space
        left = space - size
        if left:
            open_by_space[left].append(place)
            spaces |= 1 << left
    return sequence, offset


def lower_bound(lengths: np.ndarray, length: int = LENGTH) -> int:
    """No packing has fewer sequences: the best of two families of dual-feasible functions.

    The first drops pieces below a bound and rounds up those above its complement; the second
    rounds (k + 1) x / length down to k-ths.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=length + 1)
    size = np.arange(length + 1)
    best = -(-int((counts * size).sum()) // length)
    for small in range(1, length // 2 + 1):
        whole = counts[length - small + 1 :].sum()
        middle = (counts * size)[small : length - small + 1].sum()
        best = max(best, int(whole) + -(-int(middle) // length))
    for k in range(1, 40):
        parts = (k + 1) * size
        exact = parts % length == 0
        # in units of 1 / (k * length), so that whole numbers stay exact
        value = np.where(exact, size * k, parts // length * length)
        best = max(best, -(-int((counts * value).sum()) // (k * length)))
    return best


PACKED = f"{PIECE}, _row long, _group long, _bin long, offset long, _fill long, _gap int"


def _pack_groups(rows: DataFrame, length: int) -> DataFrame:
    """Pack each `_group`; `_gap` is the number of sequences above the group's bound."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row")
        sizes = group["length"].to_numpy()
        place, offset = best_fit(sizes, length)
        fill = np.bincount(place, sizes).astype(np.int64)
        gap = len(fill) - lower_bound(sizes, length)
        return group.assign(_bin=place, offset=offset, _fill=fill[place], _gap=gap)

    own = [*[c.split()[0] for c in PIECE.split(", ")], "_row", "_group"]
    return rows.select(*own).groupBy("_group").applyInPandas(run, PACKED)


def _grouped(rows: DataFrame, count: int, group_rows: int, turn: int) -> DataFrame:
    """Deal rows into groups of about `group_rows` rows, another way each turn."""
    groups = max(-(-count // group_rows), 1)
    dealt = F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(groups))
    return rows.withColumn("_group", F.lit(turn * (1 << 32)) + dealt)


def _sequences(rows: DataFrame) -> int:
    return rows.select("_group", "_bin").distinct().count()


def pack(
    docs: DataFrame,
    vocabulary: tuple[str, str, str] | None = None,
    length: int = LENGTH,
    group_rows: int = GROUP_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece."""
    cuts = materialize(pieces(docs, vocabulary or default_vocabulary(), length), "pieces")
    cuts = cuts.withColumn("_row", F.monotonically_increasing_id())
    cuts = materialize(cuts, "numbered")
    short = cuts.where(F.col("length") < length)
    total = short.count()
    packed = materialize(_pack_groups(_grouped(short, total, group_rows, 0), length), "packed")
    for turn in range(1, rounds + 1):
        bins = packed.where("_gap > 0").select("_group", "_bin", "_fill").distinct()
        bins = bins.withColumn(
            "_rank", F.expr("percent_rank() over (partition by _group order by _fill)")
        )
        emptiest = materialize(
            bins.where((F.col("_rank") <= RELEASED) & (F.col("_fill") < length)).select("_group", "_bin"),
            "emptiest",
        )
        before = emptiest.count()
        if not before:
            break
        freed = packed.join(emptiest, ["_group", "_bin"], "left_semi")
        freed = materialize(freed, "freed")
        again = _pack_groups(_grouped(freed, freed.count(), group_rows, turn), length)
        again = materialize(again, "again")
        if _sequences(again) >= before:
            break
        stay = packed.join(emptiest, ["_group", "_bin"], "left_anti")
        packed = materialize(stay.unionByName(again), "packed")
    own = [c.split()[0] for c in PIECE.split(", ")]
    full = cuts.where(F.col("length") >= length).select(
        *own, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    filled = packed.select(
        *own, (F.col("_group") * group_rows * 4 + F.col("_bin")).alias("sequence_id"), "offset"
    )
    return ids_back(filled.unionByName(full))
