"""Each stage on its own input."""

import corpus_pipeline
import pytest

from ratingloom.llm import decontamination, line_dedup, near_dedup
from ratingloom.llm.common import Scratch


@pytest.fixture(scope="module")
def stages(spark, small):
    scratch = Scratch(spark, "test")
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = scratch.save(stage(spark, docs, small))
        out.append((name, docs, new))
        docs = new
    return out


def test_columns_and_rows(stages):
    assert [n for n, _, _ in stages] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    for _, before, after in stages[:-1]:
        assert after.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}


def test_lines_then_copies_then_benchmark(spark, small, stages):
    _, before, after = stages[1]
    assert before.count() == after.count() and line_dedup.dedup_lines(before).filter("n_removed > 0").count() > 0
    _, before, after = stages[2]
    groups = near_dedup.near_components(before).select("component_id").distinct().count()
    assert after.count() == groups
    _, before, after = stages[3]
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    assert decontamination.find_contamination(after, items).filter("size(spans) > 0").count() == 0
    assert stages[4][2].count() == after.count()


def test_run(spark, small, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, small).collect()))
    assert got == sorted(map(tuple, stages[-1][2].collect()))
