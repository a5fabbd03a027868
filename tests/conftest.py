import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from winnow.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_hot(monkeypatch):
    """Make every key with a handful of rows count as hot."""
    from winnow.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
