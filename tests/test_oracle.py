"""Every query with an SQL twin, on the smallest tables."""

import pytest
from compare import connect, difference, run_oracle, run_spark

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_registry_is_consistent():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_values_as_sql(spark, duck, small, name):
    assert difference(run_spark(spark, queries()[name], small), run_oracle(duck, oracle_sql()[name])) is None


def test_input_manifest(spark, small):
    import hashlib

    rows = {r["file_name"]: r for r in queries()["input_manifest"](spark, small).collect()}
    content = open(f"{small}/orders.parquet", "rb").read()
    assert rows["orders.parquet"]["sha256"] == hashlib.sha256(content).hexdigest()
    assert rows["orders.parquet"]["file_bytes"] == len(content)
