import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starfold.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app="starfold-tests")
    yield s


def write_csv(root, name, text):
    """Write one CSV file (exact text) below ``root``."""
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


HEADER = ("order_id,sale_date,customer_name,customer_email,region,channel,product_id,"
          "product_name,category,quantity,unit_price,discount_pct,total_amount")
