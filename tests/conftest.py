import os
import sys
from datetime import datetime, timezone

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from sharefold.session import build_session  # noqa: E402
from sharefold.sources import LANDING_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "sharefold-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def landing(spark):
    """Landing rows from (feed, body, options) triples."""

    def make(*pages):
        rows = []
        for feed, body, options in pages:
            rows.append(
                (
                    feed,
                    options.get("url", f"https://feed.example/{feed}?page={options.get('page_no', 1)}"),
                    options.get("fetched_at", datetime(2018, 8, 10, 6, 0, tzinfo=timezone.utc)),
                    options.get("status", 200),
                    body if isinstance(body, bytes) else body.encode("utf-8"),
                    options.get("page_no", 1),
                    options.get("page_size", 20),
                    options.get("share_code"),
                )
            )
        return spark.createDataFrame(rows, LANDING_SCHEMA)

    return make


@pytest.fixture(scope="session")
def universe(spark):
    return spark.createDataFrame(
        [("600001", "1", "AAA"), ("000002", "2", "BBB")], "shares_code string, shares_type string, shares_name string"
    )
