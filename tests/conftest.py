import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4)


@pytest.fixture(scope="session")
def feeds(spark):
    from cardwarden.sources.driver_tables import load_feeds

    return load_feeds(spark, "/root/testdata/sf0.001")
