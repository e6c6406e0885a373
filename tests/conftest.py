import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siltstone.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**conf):
        for key, value in conf.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
