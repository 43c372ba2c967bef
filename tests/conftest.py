import pytest

from peoplelake.session import build_session
from peoplelake.sources.lake import Lake


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "peoplelake-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))
