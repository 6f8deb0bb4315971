import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cartorio.session import session

    s = session("tests", master="local[4]", shuffle_partitions=4,
                checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
