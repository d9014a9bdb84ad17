import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="clickflow-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    # tests set their own checkpoint folder only where the cluster names none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clickflow-test-"))
    yield s
    s.stop()
