import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from counterfoil.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="counterfoil-test-")
    session = build_session(
        "counterfoil-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
