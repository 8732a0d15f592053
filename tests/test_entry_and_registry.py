import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

FAST = ["features_chain", "audit_outcome", "organizations", "recommend", "augment_basic",
        "classification_metrics", "score_metrics", "eda_chi2", "rcr_by_gamma", "time_series_folds",
        "io_parquet_roundtrip"]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "discount_opt" in df.columns


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("name", FAST)
def test_oracle_match_small(spark, name):
    r = compare(spark, SF_SMALL, name, duck(SF_SMALL))
    assert r["status"] == "OK", r
