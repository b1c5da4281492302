import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from listwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    # A query whose generated code does not compile fails instead of running interpreted.
    session = local_session(spark__checkpoint__dir=shared, spark__sql__codegen__fallback="false")
    yield session
    session.stop()
