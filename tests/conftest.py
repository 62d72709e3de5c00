import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lotwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("lotwise-tests", "8", shuffle_partitions=4)


@pytest.fixture
def rows(spark):
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
