import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cairn.session import local_session

    import tempfile

    wh = tempfile.mkdtemp(prefix="cairn-wh-")
    s = local_session(
        master="local[4]", shuffle_partitions=4, app_name="cairn-tests",
        extra={"spark.sql.warehouse.dir": wh},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
