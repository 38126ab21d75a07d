"""Stages of the pipeline, each against brute force on what it is given."""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import corpus_pipeline  # noqa: E402
import test_linededup  # noqa: E402
import test_minhash  # noqa: E402
import test_packing  # noqa: E402
import test_quality  # noqa: E402
import test_secrets  # noqa: E402

from mediamix.session import cut_lineage  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(cut_lineage(stage(spark, found[-1], SF)))
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay_until_the_last_stage(steps):
    assert all(s.columns == steps[0].columns and s.dtypes == steps[0].dtypes for s in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "secret_scans", "best_fit_packing"]


def test_quality_rules(steps):
    before, after = dict(rows(steps[0])), dict(rows(steps[1]))
    assert after and all(before[k] == t and not test_quality.brute(t)[-1] for k, t in after.items())
    assert len(after) < len(before)


def test_line_dedup(steps):
    expected = test_linededup.brute(rows(steps[1]), 50)
    assert {k: [x.strip() for x in t.split("\n") if x.strip()] for k, t in rows(steps[2])} == {k: v for k, v in expected.items() if v}
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near_dedup(steps):
    expected = {key for key, _, component in test_minhash.brute(rows(steps[2]), 80) if key == component}
    assert {k for k, _ in rows(steps[3])} == expected


def test_secret_scans(steps):
    before, after = dict(rows(steps[3])), dict(rows(steps[4]))
    assert set(before) == set(after)
    for key, text in before.items():
        assert not test_secrets.brute(after[key])
        assert (text == after[key]) == (not test_secrets.brute(text))


def test_best_fit_packing(steps):
    sequences, tokens = test_packing.check(rows(steps[4]), steps[5].collect())
    assert sequences <= -(-tokens // 4096) + 1


def test_run_equals_the_stages(spark, steps):
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*keys).collect())) == sorted(map(tuple, steps[5].select(*keys).collect()))
