from __future__ import annotations

import pytest

from reviewlake.session import build_session

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def session():
    spark = build_session(
        "reviewlake-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return session()
