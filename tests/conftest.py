import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfline.sources.session import build_session

    shared = tmp_path_factory.mktemp("shared")

    session = build_session(
        "tests",
        master="local[4]",
        extra={
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"{shared}/checkpoints",
            "spark.sql.warehouse.dir": f"{shared}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def same_rows():
    """Compare frames as bags of rows, columns matched by name."""
    from compare import spark_rows

    def check(left, right):
        assert sorted(left.columns) == sorted(right.columns)
        assert spark_rows(left) == spark_rows(right)

    return check
