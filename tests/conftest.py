from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from meterlake.config import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="meterlake-test-ckpt-")
    session = build_session(
        "local[*]",
        app_name="meterlake-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"},
    )
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="meterlake-test-")
