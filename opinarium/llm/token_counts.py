"""Token counts by a linear longest-match automaton.

Greedy longest match takes, at each place of a word, the longest piece of the vocabulary.
The automaton reads each character once: where the trie has no edge, the failure link of a node
gives the node that remains after popping the longest pieces off its string, and a number says how
many pieces that pops. Lengths come out without any piece being built.

The vocabulary is a public piece file whose word-initial pieces bear a mark, so a word is read
as the mark followed by its characters. Words are runs of non-space characters.
A word that cannot be covered counts as one unknown token. NULL and empty texts have no tokens.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from opinarium.llm.common import ids_back, texts_with_ids

MARK = "▁"
COUNTS = "doc_id string, n_words long, n_tokens long, n_unknown long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> list[str]:
    """The plain pieces of a piece file: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Automaton:
    """The trie of the pieces with, for each node, its failure link and the pieces that following it pops."""

    FAIL = -1

    def __init__(self, pieces: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}]
        self.is_piece = [False]
        for piece in pieces:
            node = 0
            for letter in piece:
                after = self.edges[node].get(letter)
                if after is None:
                    after = len(self.edges)
                    self.edges[node][letter] = after
                    self.edges.append({})
                    self.is_piece.append(False)
                node = after
            self.is_piece[node] = bool(piece)
        self._link()

    def _link(self) -> None:
        """Breadth first: a node's link continues its parent's link by the node's letter."""
        size = len(self.edges)
        self.link, self.popped = [self.FAIL] * size, [0] * size
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for letter, node in self.edges[parent].items():
                todo.append(node)
                if self.is_piece[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, popped = self.link[parent], self.popped[parent]
                while at != self.FAIL and letter not in self.edges[at]:
                    popped += self.popped[at]
                    at = self.link[at]
                if at != self.FAIL:
                    self.link[node] = self.edges[at][letter]
                    self.popped[node] = popped

    def count(self, word: str) -> int:
        """Pieces of the greedy cover; -1 when there is none."""
        edges, link, popped = self.edges, self.link, self.popped
        node = total = 0
        for letter in word:
            while (after := edges[node].get(letter)) is None:
                total += popped[node]
                node = link[node]
                if node == self.FAIL:
                    return -1
            node = after
        while node:
            total += popped[node]
            node = link[node]
            if node == self.FAIL:
                return -1
        return total


class Counter:
    """Counts of whole texts; the counts of words seen are kept, and dropped when they are many."""

    WORDS_KEPT = 300_000

    def __init__(self, pieces: Iterable[str]):
        self.automaton = Automaton(pieces)
        self._known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[int, int, int]:
        """(words, tokens, unknown words)."""
        if not text:
            return 0, 0, 0
        known, count = self._known, self.automaton.count
        if len(known) > self.WORDS_KEPT:
            known.clear()
        words = text.split()
        tokens = unknown = 0
        for word in words:
            n = known.get(word)
            if n is None:
                n = known[word] = count(MARK + word)
            if n < 0:
                unknown += 1
            else:
                tokens += n
        return len(words), tokens + unknown, unknown


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every document, whole texts."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Counter(load_pieces(path))
        for batch in batches:
            rows = [count(text) for text in batch["text"]]
            out = pd.DataFrame(rows, columns=["n_words", "n_tokens", "n_unknown"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return ids_back(texts_with_ids(docs).mapInPandas(run, COUNTS))
