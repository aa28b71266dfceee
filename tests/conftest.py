import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clientele.session import local_session
    return local_session(cores=4, shuffle_partitions=8)


@pytest.fixture
def scratch():
    """A fresh scratch folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="clientele-test-")


MONEY_COLS = {"unit_cost", "total_cost", "sold_price", "gross_revenue", "refund_amount",
              "net_revenue", "gross_profit", "line_revenue"}


def line(customer_id=1, transaction_id=1, date="2024-01-01", net=10, status="Approved",
         category="Dresses", quantity=1.0, returned=0.0, refund=0, gross=None, profit=None,
         brand="B1", level=5, product_id=1):
    """One order line for hand-built frames (unspecified money follows net)."""
    gross = net if gross is None else gross
    profit = net if profit is None else profit

    def money(v):
        return None if v is None else Decimal(str(v)).quantize(Decimal("0.01"))
    return {
        "transaction_date": None if date is None else dt.date.fromisoformat(date),
        "transaction_id": transaction_id, "customer_id": customer_id, "product_id": product_id,
        "quantity": quantity, "unit_cost": money(1), "total_cost": money(1), "sold_price": money(1),
        "gross_revenue": money(gross), "refund_amount": money(refund), "net_revenue": money(net),
        "gross_profit": money(profit), "line_revenue": money(gross), "returned_qty": returned,
        "sold_price_level": level, "order_status": status, "category": category, "brand": brand,
    }


@pytest.fixture
def make_txn(spark):
    from clientele.sources.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

    def make(rows):
        return spark.createDataFrame([tuple(r[c] for c in TRANSACTION_COLUMNS) for r in rows],
                                     TRANSACTION_SCHEMA)
    return make
