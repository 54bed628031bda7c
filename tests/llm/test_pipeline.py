"""The pipeline's stages, each judged on its own input, and the whole of it."""

from __future__ import annotations

import pytest

import corpus_pipeline
from starloom.llm.common import read_table, written
from tests.conftest import SF_DIR
from tests.llm.test_operators import check_packing, plain_components, plain_hits, plain_lines, plain_metrics


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the output rows of every stage, over the whole test table."""
    docs, out = read_table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF_DIR), "result")
        out.append((docs, result))
        docs = result
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_documents(stages):
    for before, after in stages[:-1]:
        assert after.dtypes == before.dtypes


def test_quality_stage_drops_what_fails_the_base_rule(stages):
    before, after = map(texts, stages[0])
    kept = dict(after)
    for key, text in before:
        n_words, _, _, _, repeats = plain_metrics(text)
        if n_words < 50 or 100 * repeats > 50 * n_words:
            assert key not in kept
        else:
            # The labels of this table are too few to prove any cutoff.
            assert kept[key] == text


def test_line_stage(stages):
    before, after = map(texts, stages[1])
    assert dict(after) == {key: text for key, _, _, text in plain_lines(before, 10)}


def test_near_duplicate_stage_keeps_the_least_of_each_group(stages):
    before, after = map(texts, stages[2])
    groups = plain_components(before)
    assert sorted(k for k, _ in after) == sorted(key for key, _, least in groups if key == least)
    assert dict(after).items() <= dict(before).items()


def test_benchmark_stage(spark, stages):
    before, after = map(texts, stages[3])
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    clean = {key: text for key, text in before if not plain_hits(text, items)[1]}
    assert dict(after) == clean


def test_packing_stage(stages):
    before, after = stages[4]
    n, tokens = check_packing(after.collect(), texts(before), 2048)
    assert n <= -(-tokens // 2048) + 1


def test_run_equals_the_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(
        map(tuple, stages[4][1].select(*columns).collect())
    )


def test_empty_documents(spark):
    docs = read_table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
