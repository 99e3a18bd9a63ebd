import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexigrain.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "lexigrain.input.partitions": "8",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    }
    session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    return session
