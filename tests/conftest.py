from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from larder import schemas  # noqa: E402
from larder.functions.calendar import calendar  # noqa: E402
from larder.operators.star import Star  # noqa: E402
from larder.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("test tables are not here")
    return str(path)


def day(n: int) -> dt.date:
    """The n-th day of March 2026."""
    return dt.date(2026, 3, 1) + dt.timedelta(days=n - 1)


def key(d: dt.date) -> int:
    return int(d.strftime("%Y%m%d"))


PRODUCTS = [
    # key, id, name, subgroup, name, main group, name
    (1, 1001, "spinach", 10, "leaf", 1, "greens"),
    (2, 1002, "kale", 10, "leaf", 1, "greens"),
    (5, 1003, "beet", 11, "root", 1, "greens"),
    (7, 1004, "plum", 20, "stone fruit", 2, "fruit"),
    (8, 1005, "pear", 21, "pome 2", 2, "fruit"),
    (9, 1006, "odd", 22, None, 3, None),
]
STORES = [
    (1, "A", "Alpha", 100, "North"),
    (2, "B", "Beta", 100, "North"),
    (3, "C", "Gamma", 200, "South"),
    (4, "D", None, 300, None),
]


def sale(d, product, store, qty, inventory="5", revenue="10", brought="1"):
    q, i = Decimal(str(qty)), Decimal(inventory)
    return (key(d), product, store, q, Decimal(revenue), Decimal(brought), i, i < 0)


@pytest.fixture(scope="session")
def make_star(spark):
    def make(sales, products=PRODUCTS, stores=STORES, **options):
        return Star(
            sales=spark.createDataFrame(sales, schemas.SALES_SCHEMA),
            dates=calendar(spark, dt.date(2026, 3, 1), dt.date(2026, 4, 30)),
            products=spark.createDataFrame(products, schemas.PRODUCT_SCHEMA),
            stores=spark.createDataFrame(stores, schemas.STORE_SCHEMA),
            **options,
        )
    return make


@pytest.fixture(scope="session")
def month_star(make_star):
    """A month of sales for every product and store, quantities by a fixed rule."""
    sales = [
        sale(day(n), p[0], s[0], (n * 7 + p[0] * 3 + s[0] * 5) % 23 + 1 + (5 if n % 7 == 0 else 0),
             inventory=str(n % 5 - 1))
        for n in range(1, 32) for p in PRODUCTS for s in STORES
        if (n + p[0] + s[0]) % 11
    ]
    return make_star(sales)


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in chosen.collect())
