import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
# Python workers (transformWithState processors) must import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

from paths import FIXTURES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="tidemark-tests", shuffle_partitions=4)
    yield s
    s.stop()


# Inline fixtures (data values of the reference's literal sources).
LOGIN_ROWS = [
    (0, "1", "192.168.0.1", "fail", "1558430842"),
    (1, "1", "192.168.0.2", "fail", "1558430843"),
    (2, "1", "192.168.0.3", "fail", "1558430844"),
    (3, "2", "192.168.10.10", "success", "1558430845"),
]
ORDER_ROWS = [
    (0, "1", "create", "1558430842"),
    (1, "2", "create", "1558430843"),
    (2, "2", "pay", "1558430844"),
    (3, "3", "pay", "1558430942"),
    (4, "1", "pay", "1558430943"),
]
TX_ORDERS = [
    (0, "1", "create", "1558430842"),
    (1, "2", "create", "1558430843"),
    (2, "1", "pay", "1558430844"),
    (3, "2", "pay", "1558430845"),
    (4, "3", "create", "1558430849"),
    (5, "3", "pay", "1558430849"),
]
TX_PAYS = [
    (0, "1", "weixin", "1558430847"),
    (1, "2", "zhifubao", "1558430848"),
    (2, "4", "zhifubao", "1558430850"),
]


@pytest.fixture(scope="session")
def login_events(spark):
    return spark.createDataFrame(LOGIN_ROWS, "seq long, user_id string, ip string, event_type string, event_time string")


@pytest.fixture(scope="session")
def order_events(spark):
    return spark.createDataFrame(ORDER_ROWS, "seq long, order_id string, event_type string, event_time string")


@pytest.fixture(scope="session")
def tx(spark):
    o = spark.createDataFrame(TX_ORDERS, "seq long, order_id string, event_type string, event_time string")
    p = spark.createDataFrame(TX_PAYS, "seq long, order_id string, channel string, event_time string")
    return o, p


@pytest.fixture(scope="session")
def ad_clicks(spark):
    from tidemark.sources import AD_CLICK, read_delimited

    return read_delimited(spark, os.path.join(FIXTURES, "ad_clicks.csv"), AD_CLICK).cache()
