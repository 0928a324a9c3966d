from __future__ import annotations

import pytest

from docketrank.session import build_session

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("docketrank-tests", "local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def tables() -> str:
    return TABLES


@pytest.fixture
def values(spark):
    """Apply a column function to a list of texts and return the list of results."""

    def apply(function, texts, kind="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}").repartition(4)
        rows = df.select("i", function(df.t).alias("v")).collect()
        return [row["v"] for row in sorted(rows)]

    return apply


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_text
