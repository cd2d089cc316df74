import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check_oracles import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session()
    yield session
    session.stop()
