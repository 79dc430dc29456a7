import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairtables.session import build_session  # noqa: E402

DATA = os.environ.get("PAIRTABLES_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = build_session(
        "pairtables-tests",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="6g",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_check():
    return f"{DATA}/sf0.01"
