"""The stages one by one against brute force, and on odd rows."""

import corpus_pipeline
import numpy as np
import pytest
from auditlens.llm import near_dup, packing
from auditlens.llm.queries import byte_bpe
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_and_their_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("row", F.lit(1)).withColumn("score", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == before.columns and 0 < docs.count() <= before.count()
        assert docs.where("row = 1 AND score = 'mine' AND n_chars = char_length(text)").count() == docs.count()
        assert docs.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
    kept = near_dup.near_duplicates(docs)
    assert kept.where("NOT kept AND n_shingles > 200").count() == 0


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in rows}
    assert 50 < len(ids) < 200 and max(r.offset + r.length for r in rows) <= 2048
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert at.get(r.sequence_id, 0) == r.offset and len(r.ids) == 4 * r.length
        at[r.sequence_id] = r.offset + r.length
    assert len(at) <= -(-sum(at.values()) // 2048) + 1
    labels = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    assert len(ids & labels) <= 0.1 * len(labels)


def test_repeats_stage_keeps_untouched_texts(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, "own  words\nhere " + passage), (2, passage + " and others"), (3, "untouched  text\n"), (4, None), (5, ""),
            (6, " ".join(f"q{i}" for i in range(40))), (7, " ".join(f"q{i}" for i in range(40)))]
    out = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.substring_removal(spark, docs_of(rows), SF).collect()}
    assert out == {1: ("own words here", 14), 2: ("and others", 10), 3: ("untouched  text\n", 16), 4: (None, None), 5: ("", 0)}


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "a b"), (2, "a b"), (None, "some text"), (3, "y " * 5000)]])
def test_odd_tables_pass_all_stages(spark, docs_of, rows):
    docs = docs_of([*rows, (0, "x")]).where("doc_id IS NULL OR doc_id > 0")
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, SF)
    packed = packing.pack(packing.pieces_of(docs, byte_bpe()))
    assert packed.count() >= bool(rows)
    assert np.all([r.offset + r.length <= 2048 for r in packed.collect()])


@pytest.mark.parametrize("rows", [[], [(-1, None), (None, ""), (-2, "a b"), (-2, "a b"), (None, "some text"), (-3, "y " * 50_000)]])
def test_quality_stage_on_odd_rows(spark, docs_of, rows):
    """Odd rows beside the labelled documents are judged like any other, and none is changed."""
    odd = docs_of([*rows, (0, "x")]).where("doc_id IS NULL OR doc_id < 0")
    known = spark.read.parquet(f"{SF}/documents.parquet")
    docs = odd.unionByName(known).withColumn("predicted", F.lit("mine"))
    kept = corpus_pipeline.quality_filter(spark, docs, SF)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0 and kept.where("doc_id >= 0").count() > 100
    assert corpus_pipeline.quality_filter(spark, odd.limit(0), SF).count() == 0
