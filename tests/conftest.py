import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from ledgerlens.session import build_session, discard  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    discard(session)
    session.stop()


@pytest.fixture
def train_frame(spark):
    """Three labelled rows with nulls in every kind of column."""
    schema = (
        "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, card2 double, card3 double, "
        "card4 string, card5 double, card6 string, addr1 double, addr2 double, id_12 bigint, id_13 double, "
        "P_emaildomain string, R_emaildomain string, ProductCD string, DeviceType string, DeviceInfo string, isFraud int"
    )
    rows = [
        (1, 3600, 100.0, 1111, 10.0, 150.0, "visa", 226.0, "debit", 100.0, 87.0, 1, None, "gmail.com", None, "W", None, None, 0),
        (2, 7200, None, 1111, 20.0, 150.0, None, 226.0, "credit", 100.0, 87.0, 1, 10.0, "yahoo.com", "gmail.com", "C", "mobile", "ios", 1),
        (3, 90000, 300.0, 2222, None, 150.0, "mastercard", None, None, 200.0, None, 2, None, None, None, "W", None, "SM-G960U", 0),
    ]
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def split_frame(spark):
    """Twenty rows in reversed time order."""
    rows = [
        (i + 1, (20 - i) * 100, 100.0 + i, 1000 + i % 3, 200 + i % 2, 150, ["visa", "mastercard"][i % 2], 10 + i % 4, i % 2)
        for i in range(20)
    ]
    schema = (
        "TransactionID bigint, TransactionDT bigint, TransactionAmt double, card1 bigint, card2 bigint, card3 bigint, "
        "card4 string, addr1 bigint, isFraud int"
    )
    return spark.createDataFrame(rows, schema)
