import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pagelattice.session import local_session, ship

    session = local_session("4", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return ship(session)


@pytest.fixture(scope="session")
def tiny():
    """The smallest sample tables, for queries."""
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("sample tables are absent")
    return str(path)
