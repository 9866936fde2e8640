"""The pipeline against its stages' own tests, and every query over the smallest tables."""

import re

import pytest
from .samples import CLASHING

import __spark_entry__ as contract
import corpus_pipeline
from opinarium.llm import decontamination, near_duplicates, packing, queries
from opinarium.llm.common import ids_back

FOLDER = "/root/testdata/sf0.001"

ORDER = ["quality", "toxicity", "near_duplicates", "decontamination", "packing"]


def test_registered():
    names = [q for q in contract.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 11))
    assert "pipeline" in contract.queries()
    assert [name for name, _ in corpus_pipeline.STAGES] == ORDER


@pytest.fixture(scope="module")
def staged(spark):
    """The documents before the first stage and after each filtering one."""
    frames = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, frames[-1], FOLDER)
        frames.append(spark.createDataFrame(after.collect(), after.schema))
    return frames


def test_filtering_stages(spark, staged):
    for before, after, name in zip(staged, staged[1:], ORDER, strict=False):
        assert after.columns == before.columns, name
        assert after.exceptAll(before).isEmpty(), name
        assert 0 < after.count() < 200, name
    docs = staged[-1]
    classes = near_duplicates.near_duplicates(docs)
    assert classes.select("class_id").distinct().count() == docs.count()
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontamination.find_leaks(docs, bench).isEmpty()


def test_run_is_the_stages_in_turn(spark, staged):
    result = corpus_pipeline.run(spark, FOLDER)
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    expected = ids_back(packing.pieces(staged[-1], packing.default_vocabulary()))
    assert result.select(own).exceptAll(expected.select(own)).isEmpty()
    assert expected.select(own).exceptAll(result.select(own)).isEmpty()


def test_stages_keep_clashing_columns(spark, odd_docs, odd_labels, tmp_path):
    folder = str(tmp_path)
    odd_labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this anywhere")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd_docs.columns and set(CLASHING) < set(docs.columns), name
    assert corpus_pipeline.packed_sequences(spark, docs, folder).count() == packing.pieces(
        docs, packing.default_vocabulary()
    ).count()


TYPES = {
    "op1_token_counts": "doc_id bigint, n_tokens bigint",
    "op2_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op3_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_near_duplicates": "doc_id bigint, class_id bigint",
    "op5_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op7_decontamination": "doc_id bigint, item_id bigint, distance int",
    "op8_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    kinds = dict(df.dtypes)
    for column in TYPES[name].split(", "):
        key, kind = column.split()
        assert kinds[key] == kind, column
    if name == "op7_decontamination":
        assert df.count() >= 1
    elif name == "op8_packing":
        assert df.select("doc_id").distinct().count() == 200
    else:
        assert df.count() == {"op6_url_filter": 50}.get(name, 200)
