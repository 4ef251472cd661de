"""Every query against its SQL oracle on the smallest data (``tests.compare`` does larger ones)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"

# No exact SQL: text with floating-point numbers in it.
ROWS_ONLY = {"report_text", "report_json_per_commit", "report_js"}


def core(names):
    """Queries of the corpus operators have their own tests."""
    return {name for name in names if not name.startswith("op") and name != "pipeline"}



@pytest.fixture(scope="module")
def connection():
    with oracle_connection(SF) as opened:
        yield opened


def test_every_query_has_an_oracle_or_a_reason():
    assert core(queries()) == core(oracle_sql()) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(core(oracle_sql())))
def test_query_equals_oracle(spark, connection, name):
    rows, problem = difference(queries()[name](spark, SF), connection, oracle_sql()[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry(spark).count() > 0
