import random

import pytest

from opinarium.functions import fixed_values as fixed
from opinarium.operators import rules as rl

SHEET = [
    (0, "comfort", ["and+the", "", "ein+der"]),
    (1, "power", ["that", "les"]),
    (2, "empty", []),
    (3, "comfort", ["with+the", "que"]),
    (4, "dup", ["the+the"]),
    (5, "gap", ["zz++zz"]),
]


def sheet_frame(spark, rows):
    columns = ["row_order", fixed.SHEET_NAME_COLUMN, *fixed.SHEET_KEYWORD_COLUMNS]
    types = ", ".join(["row_order int", *[f"{c} string" for c in columns[1:]]])
    return spark.createDataFrame([(o, n, *k, *[None] * (10 - len(k))) for o, n, k in rows], types)


def naive(text, compiled):
    if text is None:
        return []
    return [
        name
        for _, name, clauses in sorted(compiled)
        if any(all(term in text for term in clause) for clause in clauses)
    ]


def test_compile(spark):
    compiled = rl.compile_rules(sheet_frame(spark, SHEET)).orderBy("rule_order").collect()
    assert [tuple(r) for r in compiled] == [
        (0, "comfort", [["with", "the"], ["que"]]),
        (1, "power", [["that"], ["les"]]),
        (4, "dup", [["the", "the"]]),
        (5, "gap", [["zz", "", "zz"]]),
    ]


WAYS = [rl.hits_by_condition, rl.hits_by_grams]


@pytest.mark.parametrize("way", WAYS)
def test_ways_agree_with_a_loop(spark, way):
    draw = random.Random(5)
    pieces = ["the", "with", "que", "les", "zz", " ", "that", "x", "中", "é"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(12))) for _ in range(300)]
    texts += ["", None, "the" * 50] + ["with the"] * 100
    compiled = [tuple(r) for r in rl.compile_rules(sheet_frame(spark, SHEET)).collect()]
    compiled += [(9, "always", [[""]]), (10, "part", [["he"], ["ithq"], ["中é"]])]
    frame = spark.createDataFrame(compiled, "rule_order int, name string, clauses array<array<string>>")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: r["hits"] for r in way(df, frame).collect()}
    for i, text in enumerate(texts):
        assert [h for h in found[i] or []] == naive(text, compiled), text


@pytest.mark.parametrize("way", WAYS)
def test_no_rules(spark, way):
    none = spark.createDataFrame([], "rule_order int, name string, clauses array<array<string>>")
    df = spark.createDataFrame([(1, "text")], "id int, text string")
    assert way(df, none).first()["hits"] == []


def test_keep_and_drop(spark):
    compiled = rl.compile_rules(sheet_frame(spark, SHEET))
    df = spark.createDataFrame([(1, "que les"), (2, "none here")], "id int, text string")
    kept = {r["id"]: r["hits"] for r in rl.match_rules(df, compiled).collect()}
    assert kept == {1: "comfort, power", 2: ""}
    dropped = rl.match_rules(df, compiled, keep_all=False).collect()
    assert [(r["id"], r["hits"]) for r in dropped] == [(1, ["comfort", "power"])]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_caller_names_the_way(spark):
    df = spark.createDataFrame([(1, "with the")], "id int, text string")
    compiled = rl.compile_rules(sheet_frame(spark, SHEET))
    found = [rl.find_hits(df, compiled, way=way) for way in (rl.CONDITIONS, rl.GRAMS)]
    assert all(out.first()["hits"] == ["comfort", "dup"] for out in found)
    conditions, grams = map(plan_of, found)
    assert "Join" not in conditions and "Join" in grams
    assert all("Cartesian" not in p and "NestedLoop" not in p for p in (conditions, grams))
    assert "Python" not in conditions
    with pytest.raises(ValueError):
        rl.find_hits(df, compiled, way="other")


def test_no_spread_out_row_holds_a_text(spark):
    """Texts meet their candidates once, by id; what is exploded is ids, grams and terms."""
    df = spark.createDataFrame([(1, "with the"), (2, "que")], "id int, text string")
    compiled = rl.compile_rules(sheet_frame(spark, SHEET))
    plan = rl.hits_by_grams(df, compiled, key="id")._jdf.queryExecution().optimizedPlan().toString()
    spread = [line for line in plan.splitlines() if "Generate" in line]
    assert len(spread) == 1
    below = [line.split("Generate")[1] for line in spread]
    assert all("_text" not in line.split("],")[-1] for line in below)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert sum("gram" in line for line in joins) == 1


def test_texts_are_dealt_once_and_never_broadcast(spark):
    """However small their file is: the table of texts is the left side of one join by id."""
    df = spark.createDataFrame([(1, "with the"), (2, "que")], "id int, text string")
    plan = plan_of(rl.hits_by_grams(df, rl.compile_rules(sheet_frame(spark, SHEET)), key="id"))
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    wide = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" in line]
    assert not any("text" in line for line in wide)


TERMS = ["a", "ab", "é", "日本", "seven77", "eight888", "nine99999", "nine9999", "日本語の文章", "", "end", "lowe", "😀"]


@pytest.mark.parametrize("cut", [1 << 20, 5])
def test_beginnings_of_all_lengths(spark, monkeypatch, cut):
    """Terms from one byte to more than a gram, in texts that are searched in one pass or many."""
    monkeypatch.setattr(rl, "PASS", cut)
    rows = [(i, f"r{i}", [[t]]) for i, t in enumerate(TERMS)] + [(99, "both", [["a", "end"], ["日本", "é"]])]
    rules = spark.createDataFrame(rows, "rule_order int, name string, clauses array<array<string>>")
    texts = ["", "x", "xab", "the seven77 or eight888", "nine99999", "nine9999", "日本語の文章です é", "😀 the end", "bande", None,
             "a" * 300 + "end", "n" * 40 + "nine9999", "seven7", "7seven77"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)

    def held(text):
        return [n for _, n, cs in sorted(rows) if text is not None and any(all(t in text for t in c) for c in cs)]

    for key in (None, "id"):
        found = {r["id"]: r["hits"] for r in rl.hits_by_grams(df, rules, key=key).collect()}
        assert found == {i: held(t) for i, t in enumerate(texts)}


def test_the_key_names_the_text(spark):
    texts = [(i, t) for i, t in enumerate(["the with", "with the", None, "", "que"] * 20)]
    df = spark.createDataFrame(texts, "id int, text string")
    compiled = rl.compile_rules(sheet_frame(spark, SHEET))
    one = {r["id"]: r["hits"] for r in rl.hits_by_grams(df, compiled).collect()}
    two = {r["id"]: r["hits"] for r in rl.hits_by_grams(df, compiled, key="id").collect()}
    assert one == two and one[0] == ["comfort", "dup"] and one[2] == []
