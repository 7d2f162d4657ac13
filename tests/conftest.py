import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tillwise.session import get_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        conf={
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
