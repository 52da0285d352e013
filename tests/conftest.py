import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def base() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        f"local[{os.environ.get('TEST_CORES', '8')}]",
        "tests",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_cached_for_others(spark):
    """Tables that a module's fixtures cache don't replace the plans of the modules after it."""
    yield
    spark.catalog.clearCache()
