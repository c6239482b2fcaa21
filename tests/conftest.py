import os
import shutil
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from vantle.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="vantle-test-")
    session = local_session(
        4,
        4,
        driver_memory="4g",
        **{"spark.checkpoint.dir": f"file://{folder}/shared", "spark.sql.warehouse.dir": f"file://{folder}/warehouse", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"},
    )
    ship_package(session)
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    return SF
