import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    folder = tmp_path_factory.mktemp("spark")
    session = build_session("local[8]", 4, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.checkpoint.dir": str(folder / "shared"),
        "spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from check import open_duckdb

    return open_duckdb(DATA)
