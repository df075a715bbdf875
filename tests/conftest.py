import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from loanlens.session import build_session
    s = build_session("local[*]", app_name="loanlens-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="loanlens-test-ckpt-")})
    yield s
    s.stop()
