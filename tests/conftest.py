import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import local_session, ship

    s = local_session("tests", cores=4, spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")))
    ship(s)
    yield s
