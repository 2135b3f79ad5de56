"""Every registered query against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert entry.queries()[name](spark, SF_DIR).count() > 0
    else:
        assert differences(spark, SF_DIR, entry.queries()[name], sql) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["stt", "edt", "cur_date", "keyword", "keyword_count"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
