"""Every registered query against its SQL twin on the smallest tables.

The streams are compared here only by a few of each kind; ``python -m tests.oracle`` runs all.
"""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, database
from weirflow.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_word_count", "stream_session_dynamic", "stream_interval_join", "stream_top3", "stream_text_sink"}
# These joins may have no pairs or late rows in the smallest tables.
SPARSE = {"window_join", "interval_join_late_left", "interval_join_late_right"}
NAMES = [n for n in QUERIES if not n.startswith("stream_") or n in STREAMS]


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    problem, rows = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert problem is None
    assert rows > 0 or name in SPARSE


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
