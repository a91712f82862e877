import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rastro.session import build_session, shared_folder  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test data")
    return str(folder)
