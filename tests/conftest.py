import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weirflow.session import local_session, use_keyed_state_store  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=2)
    use_keyed_state_store(session)
    yield session
    session.stop()
