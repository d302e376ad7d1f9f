import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plantlens.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "plantlens-tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="8g",
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
