import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8, **{"spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    """Folder of the small given tables; tests that need them are skipped without."""
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not Path(folder).exists():
        pytest.skip("given tables are not there")
    return folder


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
