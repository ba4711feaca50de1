import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from seqtally.session import build_session
    session = build_session("tests", master="local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="seqtally-tests-"),
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="seqtally-tests-")})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def write(tmp_path):
    """Write text to a file (given as a relative path) and return its full path."""
    def put(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        return str(path)
    return put
