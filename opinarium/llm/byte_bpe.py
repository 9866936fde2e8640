"""Byte-level BPE encoding and decoding by a two-tier lookup.

A text is split by the vocabulary's pattern. First tier: a minimal perfect hash says whether a whole
pre-token is a token; its table has exactly one slot per token and the token in the slot
is compared, so an unknown pre-token is never taken for a known one. Second tier, for misses: the
bytes of the pre-token form a linked list, and a heap of neighbouring pairs gives the pair of the
lowest rank, leftmost first, until no pair is a token. The ranks of pairs are a table by the ids of both.

Both tables are built once on the driver from a vocabulary file, whose size is their bound, and broadcast.

NULL and empty texts have no ids; no ids decode to no bytes. Texts of any length are encoded whole.
Repeated rows are encoded each for itself, an empty table gives an empty result, and columns other
than `doc_id` and `text` (`ids` for decoding) are not looked at, so their names cannot clash. A NULL
list of ids, or one with an id that is NULL or outside the vocabulary, decodes to NULL.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from opinarium.llm.common import chunks, kept

BUCKET = 3  # tokens per bucket of the perfect hash, on average
BATCH_BYTES = 4 << 20  # text or ids that leave a worker in one batch
SPREAD, MIX, MASK = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), (1 << 64) - 1
OTHER = "\ue000"  # neither letter, digit nor space in any version of Unicode


def default_vocabulary() -> tuple[str, str]:
    """The file of ranks and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a file of ranks, by id."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _digest(key: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(key)


class PerfectHash:
    """A minimal perfect hash by displacement: n keys, n slots.

    Keys fall into buckets; a bucket's displacement is the first that sends its keys to free
    slots, largest buckets first. A bucket of one key names its slot itself.
    """

    def __init__(self, n: int, displacements: list[int]):
        self.n, self.displacements = n, displacements

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        count = max(1, -(-n // BUCKET))
        digests = [_digest(key) for key in keys]
        buckets: list[list[int]] = [[] for _ in range(count)]
        for digest in set(digests):
            buckets[digest % count].append(digest)
        if sum(map(len, buckets)) < n:
            raise ValueError("two tokens have one digest")
        found = cls(n, [0] * count)
        free = np.ones(max(n, 1), bool)
        few, many = np.arange(1 << 5, dtype=np.uint64), np.arange(1 << 12, dtype=np.uint64)
        for b in sorted(range(count), key=lambda b: -len(buckets[b])):
            size = len(buckets[b])
            if size == 1:
                slot = int(free.argmax())
                free[slot] = False
                found.displacements[b] = -1 - slot
            if size < 2:
                continue
            digest = np.array(buckets[b], np.uint64)
            start = 0
            while True:
                d = (many if start else few) + np.uint64(start)
                mixed = (digest[:, None] ^ (d * SPREAD)) * MIX
                slots = (mixed >> np.uint64(32)) % np.uint64(n)
                apart = np.sort(slots, axis=0)
                fits = free[slots].all(axis=0) & (apart[1:] != apart[:-1]).all(axis=0)
                if fits.any():
                    at = int(fits.argmax())
                    free[slots[:, at]] = False
                    found.displacements[b] = start + at
                    break
                start += len(d)
        return found

    def slot(self, key: bytes) -> int:
        digest, n = _digest(key), self.n
        d = self.displacements[digest % len(self.displacements)]
        if d < 0:
            return -1 - d
        mixed = (digest ^ d * int(SPREAD) & MASK) * int(MIX) & MASK
        return (mixed >> 32) % n


def newer_letters(pattern: str) -> str:
    """Letters and digits to the pattern matcher here that are neither to the rank library, as ranges.

    The two follow different versions of Unicode. Only code points that a third, older version does
    not assign can differ, and the rank library is asked for these: with one merge of a
    letter (or digit) and any byte, it joins two characters exactly if its pattern does.
    """
    import regex
    import tiktoken

    points = map(chr, chain(range(0x80, 0xD800), range(0xE000, 0x110000)))
    new = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(points)) if unicodedata.category(c) == "Cn"]
    kept = set()
    for lead in ("x", "1"):
        ranks = {bytes([i]): i for i in range(256)}
        ranks |= {lead.encode() + bytes([i]): 128 + i for i in range(128, 256)}
        ask = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        kept |= {c for c in new if ask.encode_ordinary(lead + c)[0] >= 256}
    runs: list[list[int]] = []
    for point in (ord(c) for c in new if c not in kept):
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


class Splitter:
    """The pre-tokens of a text, as the rank library cuts them."""

    def __init__(self, pattern: str, newer: str):
        import regex

        self._cut = regex.compile(pattern)
        self._newer = regex.compile(f"[{newer}]") if newer else None
        # first byte of the first of them in UTF-8: texts without a byte as high are not searched
        self._high = chr(int(newer[2:10], 16)).encode()[0] if newer else 256

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or max(text.encode()) < self._high or not self._newer.search(text):
            return self._cut.findall(text)
        masked = self._newer.sub(OTHER, text)
        return [text[m.start() : m.end()] for m in self._cut.finditer(masked)]


class _Known(dict):
    """Ids of pre-tokens seen, four bytes each; dropped when they are many, as they can be found again."""

    KEPT, LONGEST = 600_000, 64

    def __init__(self, ids):
        super().__init__()
        self._ids = ids

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self._ids(piece.encode())).tobytes()
        if len(piece) <= self.LONGEST:
            if len(self) >= self.KEPT:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Ids of texts and bytes of ids."""

    def __init__(
        self,
        tokens: list[bytes],
        slots: list[int],
        displacements: list[int],
        pairs: dict[int, int],
        pattern: str,
        newer: str,
    ):
        """`slots`: the id in each slot of the perfect hash; `pairs`: the token that two tokens make,
        by both ids in one number."""
        self.tokens, self._id_in_slot = tokens, slots
        self._hash = PerfectHash(len(slots), displacements)
        self._pairs = pairs
        self._blob = np.frombuffer(b"".join(tokens), np.uint8)
        self._sizes = np.array([len(token) for token in tokens])
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._byte_ids = [self.find(bytes([byte])) for byte in range(256)]
        self._split = Splitter(pattern, newer)
        self._known = _Known(self._of_piece)

    @staticmethod
    def parts(path: str, pattern: str) -> tuple:
        """What a codec is made of, in plain values that can be broadcast."""
        tokens = load_ranks(path)
        if sum(len(token) == 1 for token in tokens) < 256:
            raise ValueError("a byte-level vocabulary has every byte")
        named = [i for i, token in enumerate(tokens) if token]
        table = PerfectHash.build([tokens[i] for i in named])
        slots = [0] * len(named)
        for i in named:
            slots[table.slot(tokens[i])] = i
        id_of = {tokens[i]: i for i in named}
        pairs = {
            left << 32 | right: i
            for i in named
            for cut in range(1, len(tokens[i]))
            if (left := id_of.get(tokens[i][:cut])) is not None
            and (right := id_of.get(tokens[i][cut:])) is not None
        }
        return tokens, slots, table.displacements, pairs, pattern, newer_letters(pattern)

    def find(self, piece: bytes) -> int:
        """The id of a token, -1 for other bytes."""
        i = self._id_in_slot[self._hash.slot(piece)]
        return i if self.tokens[i] == piece else -1

    def _of_piece(self, piece: bytes) -> list[int]:
        whole = self.find(piece)
        return [whole] if whole >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Ids after all merges. A part starts at its index and ends at `end`; parts are linked."""
        n, rank_of = len(piece), self._pairs.get
        ids = list(map(self._byte_ids.__getitem__, piece))
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # a part that is gone has id -1; an entry holds the ids it was made for, else it is stale
        heap = [
            (rank, i, i + 1)
            for i in range(n - 1)
            if (rank := rank_of(ids[i] << 32 | ids[i + 1])) is not None
        ]
        heapify(heap)
        while heap:
            rank, i, middle = heappop(heap)
            left = ids[i]
            if left < 0 or end[i] != middle or rank_of(left << 32 | ids[middle]) != rank:
                continue
            ids[middle] = -1
            ids[i], end[i] = rank, (stop := end[middle])
            if stop < n:
                before[stop] = i
                if (new := rank_of(rank << 32 | ids[stop])) is not None:
                    heappush(heap, (new, i, stop))
            if (back := before[i]) >= 0 and (new := rank_of(ids[back] << 32 | rank)) is not None:
                heappush(heap, (new, back, i))
        return [i for i in ids if i >= 0]

    def encode(self, text: str | None) -> np.ndarray:
        pieces = self._split(text) if text else []
        return np.frombuffer(b"".join(map(self._known.__getitem__, pieces)), np.int32)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes of neighbouring lists of ids, of the given sizes; NULL for one with a foreign id."""
        known = (ids >= 0) & (ids < len(self._sizes))
        known[known] = self._sizes[ids[known]] > 0
        ids = np.where(known, ids, 0)
        lengths = np.where(known, self._sizes[ids], 0)
        ends = np.cumsum(lengths)
        within = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._starts[ids] - (ends - lengths), lengths)
        # the places of the lists: among the ids, then among the bytes
        stops = np.concatenate([[0], np.cumsum(sizes)])
        offsets = np.concatenate([[0], ends])[stops]
        made = pa.Array.from_buffers(
            pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self._blob[within])]
        )
        foreign = np.diff(np.concatenate([[0], np.cumsum(~known)])[stops]) > 0
        return pa.compute.if_else(pa.array(foreign), pa.scalar(None, pa.large_binary()), made).cast(pa.binary())


def _codec(docs: DataFrame, vocabulary: tuple[str, str] | None):
    parts = Codec.parts(*(vocabulary or default_vocabulary()))
    return docs.sparkSession.sparkContext.broadcast(parts)


def encode(docs: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, ids) of every document: the ids of its whole text."""
    parts = _codec(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(parts, lambda made_of: Codec(*made_of))
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string())
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1])
            for some in chunks(sizes.tolist(), BATCH_BYTES):
                rows = [codec.encode(text.as_py()) for text in texts[some]]
                offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
                yield pa.record_batch([batch.column(0)[some], lists], names=["doc_id", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that lists of ids stand for."""
    parts = _codec(encoded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(parts, lambda made_of: Codec(*made_of))
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for some in chunks((sizes * 4).tolist(), BATCH_BYTES):
                part = lists[some]
                ids = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                made = pa.compute.if_else(part.is_valid(), codec.decode(ids, sizes[some]), pa.scalar(None, pa.binary()))
                yield pa.record_batch([batch.column(0)[some], part, made], names=["doc_id", "ids", "bytes"])

    schema = "doc_id long, ids array<int>, bytes binary"
    return encoded.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids").mapInArrow(run, schema)
