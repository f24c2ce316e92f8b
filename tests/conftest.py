import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from ticketlens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(shared),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    import __spark_entry__ as entry

    return entry.star(spark, SMALL)


@pytest.fixture(scope="session")
def con():
    from compare import duck

    return duck(SMALL)
