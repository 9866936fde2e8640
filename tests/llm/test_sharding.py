"""Slots, maps and places against a loop over the rows."""

import zlib
from collections import Counter

import pytest
from .samples import odd_rows, prose
from pyspark.sql import functions as F

from opinarium.llm import sharding

ROWS = (1,) * sharding.PARTS


def test_given_documents(some_docs):
    rows = {r["doc_id"]: r["text"] for r in some_docs.collect()}
    found = sharding.shard_documents(some_docs, 16).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(rows)
    loads, places = Counter(), {}
    for r in found:
        text = rows[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 1
        assert r["text_crc32"] == zlib.crc32(text.encode())
        loads[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
    assert set(loads) <= set(range(16))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    groups = Counter()
    for r in found:
        groups[rows[r["doc_id"]]] += r["size"]
    mean = sum(loads.values()) / 16
    assert max(loads.values()) <= max(1.02 * mean, max(groups.values()))
    together = {}
    for r in found:
        together.setdefault(rows[r["doc_id"]], set()).add(r["shard"])
    assert all(len(s) == 1 or groups[t] > mean for t, s in together.items())


def test_a_third_of_the_rows_with_one_text(spark):
    rows = [(i, "one text of all of these rows" if i % 3 == 0 else prose(i, 4)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(sharding.heavy_texts(docs, 16)) == 1
    found = sharding.shard_documents(docs, 16)
    loads = [r["s"] for r in found.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(loads) == 16 and max(loads) <= 1.02 * sum(loads) / 16
    nulls = spark.createDataFrame([(i, None) for i in range(500)], "doc_id long, text string")
    counts = [r["count"] for r in sharding.shard_documents(nulls, 16).groupBy("shard").count().collect()]
    assert len(counts) == 16 and max(counts) - min(counts) <= 1


def test_a_slot_is_ranked_in_parts(spark):
    docs = spark.createDataFrame([(i, "same") for i in range(1000)], "doc_id long, text string")
    made = sharding.first_map(sharding.slot_totals(docs), 2)
    found = sharding.assign(docs, made).collect()
    assert sorted(r["slot"] for r in found) == list(range(1000)) and len({r["shard"] for r in found}) == 1
    assert max(max(n) for n in made.rows) < 120


def test_sizes_are_near_equal_where_no_text_is_large(spark):
    rows = [(i, prose(i, 5 + i % 50)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    loads = [r["s"] for r in sharding.shard_documents(docs, 16).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(loads) == 16 and max(loads) - min(loads) <= 20


def test_rebalancing_moves_whole_slots_to_lighter_shards():
    totals = [(s, 10 + s % 7 * 100, ROWS) for s in range(64)]
    first = sharding.first_map(totals, 4, 64)
    after = sharding.rebalanced(first)
    assert after.version == 1 and after.bytes == first.bytes
    spread = max(after.loads()) - min(after.loads())
    assert spread <= max(first.loads()) - min(first.loads()) and spread <= 100
    assert sum(after.loads()) == sum(first.loads())
    assert sharding.rebalanced(after).shard == after.shard


def test_a_new_shard_only_takes():
    totals = [(s, 50 + s * 13 % 40, ROWS) for s in range(256)]
    before = sharding.rebalanced(sharding.first_map(totals, 8, 256))
    after = sharding.grown(before)
    assert after.shards == 9
    assert all(b == a or b == 8 for a, b in zip(before.shard, after.shard, strict=True))
    loads = after.loads()
    assert abs(loads[8] - sum(loads) / 9) <= 100


def test_maps_are_stored_by_version(spark, tmp_path):
    folder = str(tmp_path / "maps")
    made = [sharding.first_map([(3, 9, ROWS), (4, 1, ROWS)], 2, 8, [-7, 5])]
    made.append(sharding.rebalanced(made[0]))
    for one in made:
        sharding.save_map(spark, one, folder)
    assert sharding.load_map(spark, folder) == made[1]
    assert sharding.load_map(spark, folder, 0) == made[0]
    sharding.save_map(spark, made[1], folder)
    assert sharding.load_map(spark, folder) == made[1]


def test_odd_rows(odd_docs):
    found = sharding.shard_documents(odd_docs, 3, 64).collect()
    expected = Counter((r[0], len((r[1] or "").encode()) + 1) for r in odd_rows())
    assert Counter((r["doc_id"], r["size"]) for r in found) == expected
    places = {}
    for r in found:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_written_shards_hold_the_documents(spark, odd_docs, tmp_path):
    made = sharding.balanced_map(odd_docs, 4)
    sharding.write_shards(odd_docs, made, str(tmp_path / "out"))
    back = spark.read.schema(odd_docs.schema).parquet(str(tmp_path / "out")).select(odd_docs.columns)
    assert back.exceptAll(odd_docs).isEmpty() and odd_docs.exceptAll(back).isEmpty()


def test_empty_table(no_docs):
    assert sharding.shard_documents(no_docs).count() == 0


def test_no_python_in_the_plan(some_docs):
    plan = sharding.shard_documents(some_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [1, 5])
def test_fewer_rows_than_shards(spark, n):
    docs = spark.createDataFrame([(i, "x" * i) for i in range(n)], "doc_id long, text string")
    found = sharding.shard_documents(docs, 16).collect()
    assert len(found) == n and len({r["shard"] for r in found}) == n
