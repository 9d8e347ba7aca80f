"""Registered corpus queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import check
from lossmill.llm import oracles, queries

FOLDER = entry.SMOKE_FOLDER
needs_data = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not there")


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registered())
    assert numbers == list(range(1, 14))
    assert set(queries.registered()) | {"pipeline"} <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{FOLDER}/{name_}.parquet'")
    found = queries.registered()[name](spark, FOLDER).toPandas()
    assert check.compare(found, db.execute(oracles.oracle_sql()[name]).df()) == ""
