"""Queries of the operators against their SQL twins, names and types included."""

from __future__ import annotations

import duckdb
import pytest

from docketrank.llm.oracles import ORACLE
from docketrank.llm.queries import QUERIES

SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, tables, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    df = QUERIES[name](spark, tables)
    result = connection.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {column: SQL_TYPES[kind] for column, kind in df.dtypes} == types
    wanted = result.fetchall()
    got = [tuple(row) for row in df.select(*types).collect()]

    def ordered(rows):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows), key=str)

    assert ordered(got) == ordered(wanted)
