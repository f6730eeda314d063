import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagwerk.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, request):
    return scratch_path(spark, f"test-{request.node.name[:40]}")
