from __future__ import annotations

import pytest

from panelkit.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=8,
        **{
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return SMALL
