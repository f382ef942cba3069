import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Make every join shuffle, as it would with large sides."""
    from shelfline.operators import joins, sizing, validity

    for module in (joins, validity):
        monkeypatch.setattr(module, "is_small", lambda df, limit=0: False)
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df, limit=0: df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sizing.BROADCAST_LIMIT_BYTES > 0
