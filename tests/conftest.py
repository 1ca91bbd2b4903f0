import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
for folder in (os.path.dirname(HERE), HERE):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from ratewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4, memory="8g")
    # The session names no shared folder, so the tests set their own.
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
