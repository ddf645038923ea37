import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from patronage.session import local_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4)
    shared_folder(session)
    yield session
    session.stop()
