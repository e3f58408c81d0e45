"""Every registered query equals its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from tidemart.queries import REGISTRY
from tidemart.testing import compare, duck

SF_SMALL = "/root/testdata/sf0.001"

KEYS = sorted(set(E.oracle_sql()) & set(REGISTRY))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = set(REGISTRY) - set(E.oracle_sql())
    assert missing <= {"src_file_stream", "late_drop", "sink_jsonl_roundtrip", "sink_dynamic_topic"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    assert compare(df, con, E.oracle_sql()[key]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "order_amount" in df.columns
