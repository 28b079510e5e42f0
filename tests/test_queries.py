"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from checks import oracles
from compare import compare

SF_DIR = "/root/testdata/sf0.001"
STREAMS = {"stream_dedup_window", "stream_realtime", "stream_errors"}


def test_every_query_has_an_oracle():
    assert set(oracles.ORACLES) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(set(oracles.ORACLES) - STREAMS))
def test_query_equals_sql(spark, name):
    compare(spark, registered.queries()[name], registered.oracle_sql()[name], SF_DIR)


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_equals_sql(spark, name):
    compare(spark, registered.queries()[name], registered.oracle_sql()[name], SF_DIR)


def test_entry_gives_rows(spark):
    assert registered.entry(spark).count() > 0
