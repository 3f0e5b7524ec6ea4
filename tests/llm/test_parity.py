"""Queries of the subpackage against their SQL, and the driver contract."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES
from tests.parity import compare, connect

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    ok, account = compare(spark, connect(SMALL), name, QUERIES[name], ORACLES[name], SMALL)
    assert ok, account
