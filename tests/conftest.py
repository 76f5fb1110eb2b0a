from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from appraise.session import get_session

    s = get_session(
        "appraise-tests", master="local[4]", shuffle_partitions=4,
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true"},
    )
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
