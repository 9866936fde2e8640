"""Decontamination, URL filters and token counts against brute force."""

import itertools
import math
import zlib
import random
import re
from collections import Counter
from urllib.parse import quote

import pytest
from .samples import odd_rows, prose

from opinarium.llm import decontamination as leaks
from opinarium.llm import token_counts as tokens
from opinarium.llm import url_filter as urls


# --- decontamination


def closest(item, text):
    """Least edit distance of the item to any substring, row by row."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


def test_myers_against_the_table():
    rng = random.Random(4)
    for _ in range(300):
        item = "".join(rng.choices("ab ", k=rng.randint(1, 12)))
        text = "".join(rng.choices("ab ", k=rng.randint(0, 30)))
        distance, end = leaks.Myers(item).best(text)
        assert distance == closest(item, text)
        assert closest(item, text[:end]) == distance


def test_pieces_cover_the_item():
    for size in range(1, 60):
        for edits in range(8):
            parts = leaks.split_pieces("x" * size, edits)
            assert "".join(p for _, p in parts) == "x" * size
            assert all(p for _, p in parts) and len(parts) == min(edits + 1, size)


def edited(text, edits, rng):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = "q"
        elif kind == 1:
            letters.insert(at, "q")
        else:
            del letters[at]
    return "".join(letters)


def test_leaks_against_all_pairs(spark):
    rng = random.Random(8)
    items = [(i, prose(500 + i, 20 + i)) for i in range(12)]
    rows = []
    for i in range(60):
        text = prose(i, 60)
        if i % 3:
            item = items[i % 12][1]
            text += " " + edited(item, i % 11, rng).upper() + ", " + prose(i + 100, 30)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in leaks.find_leaks(docs, bench).collect()}
    expected = {}
    for d, text in rows:
        for i, item in items:
            pattern = leaks.normal(item)
            distance = closest(pattern, leaks.normal(text))
            if distance <= int(len(pattern) * leaks.ERROR_SHARE):
                expected[d, i] = distance
    assert found == expected and len(expected) > 15
    blocks = leaks.find_leaks(docs, bench, block_chars=300).collect()
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in blocks} == expected


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "PLAIN  words here and some more of them"), (2, None), (3, "  ,"), (4, ""), (5, "Plain words here and some more of them")],
        "item_id long, text string",
    )
    found = leaks.find_leaks(odd_docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(1, 1), (1, 1), (1, 5), (1, 5)]
    kept = leaks.keep_clean(odd_docs, bench)
    assert kept.schema == odd_docs.schema
    assert kept.count() == odd_docs.count() - 2
    assert leaks.find_leaks(no_docs, bench).count() == 0
    assert leaks.keep_clean(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_given_benchmark(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = {r["item_id"]: leaks.normal(r["text"]) for r in bench.collect()}
    exact = {
        (r["doc_id"], i) for r in docs.collect() for i, text in items.items() if text in leaks.normal(r["text"])
    }
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in leaks.find_leaks(docs, bench).collect()}
    assert exact and exact == {pair for pair, distance in found.items() if distance == 0}


# --- URL filters


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule_for(host, path):
    fit = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fit, key=lambda r: len(r[0] + r[1]), default=None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM", "http://example.com/en/x?y#z", "x://net/es/", "x://a.net/fr/q",
    "http://notexample.com/en/", "https://www.example.com/en/", "https://b.www.example.com/en/1", "http://com/", "http://com",
    "http://a.b/c://d/e", "http://ÄÖ.org/É", "http://a.org?q=/en/", "http://a.org#/x", "http://casinowin.org/", "http://x\n.net/es/\n1",
    "http://example.com/EN/x", "http://" + "a" * 300 + ".org/", "://x.org/" + quote("ü"),
]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_urls_are_split_and_ruled(spark):
    html = "<p>win the casino now</p><script>x casinowin</script>"
    found = urls.judge_urls(pages_of(spark, [(i, u, html) for i, u in enumerate(URLS)])).collect()
    assert len(found) == len(URLS)
    for r in found:
        host, path = url_parts(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        rule = rule_for(host, path)
        assert r["rule"] == (rule[0] + rule[1] if rule else None)
        assert r["verdict"] == (rule[2] if rule else ("block" if r["score"] >= 0.5 else "allow"))
    by = {URLS[r["page_id"]]: r for r in found}
    assert by["http://casinowin.org/"]["words"][:2] == ["casino", "win"]


def test_segmentation_against_all_splits():
    rng = random.Random(6)
    for _ in range(200):
        weights = {"".join(rng.choices("ab", k=rng.randint(1, 4))): -rng.random() * 5 for _ in range(8)}
        label = "".join(rng.choices("abc", k=rng.randint(1, 9)))

        def value(parts, weights=weights):
            total = 0.0
            for p in parts:
                if p in weights:
                    total += weights[p]
                elif len(p) == 1:
                    total -= 7.0
                else:
                    return None
            return total

        def splits(text):
            if not text:
                yield []
            for n in range(1, len(text) + 1):
                for rest in splits(text[n:]):
                    yield [text[:n], *rest]

        best = max(v for s in splits(label) if (v := value(s)) is not None)
        words = urls.label_words(label, weights, -7.0)
        assert "".join(words) == label
        mine = sum(weights[w] if w in weights else -7.0 * len(w) for w in words)
        assert mine == pytest.approx(best)


def test_model_blocks_bad_hosts(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = urls.judge_urls(pages).where("rule is null and host != ''").collect()
    bad = [r for r in found if set(r["words"]) & set(urls.SEEDS)]
    good = [r for r in found if not set(r["words"]) & set(urls.SEEDS)]
    assert len(good) > 20 and sum(r["verdict"] == "allow" for r in good) > 0.95 * len(good)
    assert all(r["verdict"] == "block" for r in bad)


def test_words_of_one_hash_keep_their_own_weights(spark):
    seen, pair = {}, None
    for i in itertools.count():
        word = "".join(chr(97 + i // 26**k % 26) for k in range(5))
        if (pair := (seen.setdefault(zlib.crc32(word.encode()) % 65_536, word), word))[0] != word:
            break
    rows = [(i, f"http://{('casino', 'garden')[i % 2]}.org/{pair[i % 2]}", "") for i in range(40)]
    found = urls.judge_urls(pages_of(spark, rows)).collect()
    own = {r["page_id"]: [*r["words"], pair[r["page_id"] % 2]] for r in found}
    counts = [Counter(w for i, ws in own.items() if i % 2 == side for w in ws) for side in (0, 1)]
    width = len(counts[0] | counts[1])
    for r in found:
        odds = sum(
            math.log((counts[0][w] + 0.5) / (counts[0].total() + width / 2))
            - math.log((counts[1][w] + 0.5) / (counts[1].total() + width / 2))
            for w in own[r["page_id"]]
        )
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_odd_pages(spark):
    rows = [(1, "http://a.b/c", None), (1, "http://a.b/c", None), (None, None, ""), (2, "http://9.9.9.9/1", "<b>"), (3, "http://-._/", "x" * 100_000)]
    found = urls.judge_urls(pages_of(spark, rows)).collect()
    assert len(found) == len(rows)
    assert urls.judge_urls(pages_of(spark, [])).count() == 0


# --- token counts


def greedy(pieces, word):
    """Pieces of the longest-match cover, None if there is none."""
    at, n = 0, 0
    longest = max(map(len, pieces))
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return None
        at, n = at + size, n + 1
    return n


def test_automaton_against_greedy_search():
    rng = random.Random(9)
    for _ in range(150):
        pieces = {"".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 14))}
        automaton = tokens.Automaton(sorted(pieces))
        for _ in range(40):
            word = "".join(rng.choices("abcd", k=rng.randint(0, 14)))
            expected = greedy(pieces, word)
            assert automaton.count(word) == (-1 if expected is None else expected)


def test_counts_of_given_documents(some_docs):
    pieces = set(tokens.load_pieces(tokens.default_vocabulary()))
    assert len(pieces) > 30_000
    rows = {r["doc_id"]: r["text"] for r in some_docs.where("length(text) < 3000").collect()}
    for r in tokens.count_tokens(some_docs).where("n_words < 300").collect():
        text = rows.get(r["doc_id"])
        if text is None:
            continue
        counts = [greedy(pieces, tokens.MARK + w) for w in text.split()]
        assert r["n_words"] == len(counts)
        assert r["n_unknown"] == sum(c is None for c in counts)
        assert r["n_tokens"] == sum(1 if c is None else c for c in counts)


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    found = tokens.count_tokens(odd_docs).collect()
    assert len(found) == len(odd_rows())
    by = {r["doc_id"]: r for r in found}
    assert {2**62 + 1, 2**63 - 1, -(2**63), None} < set(by)
    assert all(by[i]["n_tokens"] == by[i]["n_words"] == 0 for i in (2, 3, 4, 5))
    assert by[9]["n_unknown"] <= by[9]["n_words"] <= by[9]["n_tokens"]
    assert tokens.count_tokens(no_docs).count() == 0
