"""Invented texts and rows at the edges of what tables hold."""

import random

WORDS = "the of and to in that it was his he with for as had is not by on be at you my".split()
# Names that the operators use for their own columns.
CLASHING = "key part row label _score _predicted _stats _features _words n band sig a b slot shard".split()


def prose(seed: int, words: int) -> str:
    """Invented words, hardly ever the same five in a row."""
    rng = random.Random(seed)
    made = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=rng.randint(2, 8))) for _ in range(words)]
    return " ".join(w if rng.random() < 0.8 else rng.choice(WORDS) for w in made)


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and blank texts, repeated rows and ids, a very long text."""
    long_text = prose(1, 30_000)
    rows = [
        (1, "Plain words here, and some more of them.", "en", "a"),
        (1, "Plain words here, and some more of them.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", "de", None),
        (4, "", None, "b"),
        (5, "   \n\t ", None, None),
        (None, "No id but a text of a few words.", "en", "a"),
        (None, None, None, None),
        (6, long_text, "en", "a"),
        (7, long_text, "en", "b"),
        (8, "x", "fr", "a"),
        (9, "日本語の文章です。 Ελληνικά κείμενα, и русский.", None, "a"),
        (10, "😀 emoji 😀\u0000 and ퟿ odd <|endoftext|> signs   ", "en", "a"),
        (10, "the same id with another text", "en", "a"),
        (11, "a" * 50_000, "en", "a"),
        (2**62 + 1, "a very large id", "en", "a"),
        (2**63 - 1, "the largest id", "en", "a"),
        (-(2**63), "the smallest id", "en", "a"),
    ]
    return rows
