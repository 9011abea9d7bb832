import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from passagecraft.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session(8, memory="8g", shared=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def one_query_a_block(spark):
    """Query batches are cut into as many blocks as can be."""
    spark.conf.set("spark.passagecraft.queryBlockBytes", "1")
    yield
    spark.conf.unset("spark.passagecraft.queryBlockBytes")


@pytest.fixture
def no_broadcast(spark):
    """Every measured table is too large to broadcast."""
    spark.conf.set("spark.passagecraft.broadcastBytes", "0")
    yield
    spark.conf.unset("spark.passagecraft.broadcastBytes")


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted(tuple(r) for r in df.select(*order).collect())
