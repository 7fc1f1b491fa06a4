import datetime
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tillmark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


EVENT_SCHEMA = (
    "event_id string, order_id string, customer_record_id string, customer_id string, product_id string, "
    "category string, brand string, event_time timestamp_ntz, event_type string, quantity double, "
    "unit_price double, discount_rate double, unit_cost double, channel string, origin_event_id string, "
    "signed_quantity bigint, net_minor bigint, margin_minor bigint, net_revenue double, gross_margin double"
)


SIGNS = {"sale": 1, "return": -1, "cancelled": 0}


def event(event_id, day, kind="sale", origin="", quantity=1, customer="C1", order=None, price=25.0, cost=9.5, **others):
    """A line as the enriched tables hold it; every amount follows from quantity, price, discount and cost."""
    price, cost = others.pop("unit_price", price), others.pop("unit_cost", cost)
    discount, units = others.pop("discount_rate", 0.0), SIGNS[kind] * quantity
    net = round(units * price * (1 - discount) * 100)
    margin = net - round(units * cost * 100)
    line = {"event_id": event_id, "event_time": datetime.datetime.fromisoformat(day), "event_type": kind, "origin_event_id": origin}
    line |= {"customer_id": customer, "customer_record_id": "R1", "order_id": order or f"of-{event_id}"}
    line |= {"product_id": "P1", "category": "Garden", "brand": "Oak", "channel": "online"}
    line |= {"quantity": float(quantity), "signed_quantity": units, "unit_price": price, "unit_cost": cost, "discount_rate": discount}
    line |= {"net_minor": net, "margin_minor": margin, "net_revenue": net / 100, "gross_margin": margin / 100}
    return line | others


@pytest.fixture
def events(spark):
    names = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]

    def build(*rows):
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], EVENT_SCHEMA)

    return build
