"""The driver's contract."""

from __future__ import annotations

import __spark_entry__


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_sql_is_for_registered_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
