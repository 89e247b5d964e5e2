"""Every registered query against its DuckDB oracle on the smallest test scale."""
import os

import pytest

from tools_check import compare_one

SF = os.environ.get("RS_ORACLE_SF", "/root/testdata/sf0.001")

import __spark_entry__ as entry  # noqa: E402

from retail_signals.plans.queries import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rec = compare_one(spark, SF, name)
    assert rec["rows"] == rec["oracle_rows"]
    assert rec["cols_match"]
    assert rec["hash_match"], rec.get("diff_sample")


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) & set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["anomaly_id", "date"]
    assert df.count() >= 0
