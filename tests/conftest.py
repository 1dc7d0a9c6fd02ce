import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tributary import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    built = session.build(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    built.sparkContext.setLogLevel("ERROR")
    return built
