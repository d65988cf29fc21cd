import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martloom.session import local_session  # noqa: E402
from martloom.sources.schemas import SCHEMAS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    SparkSession.builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    s = local_session("4", partitions=4, memory="4g", name="tests")
    s.sparkContext.setLogLevel("ERROR")
    return s


ORDER_DEFAULTS = {
    "order_id": "1",
    "created_at": dt.datetime(2024, 1, 1),
    "order_date": dt.date(2024, 1, 1),
    "customer_email": "a@x",
    "total_price": 1000,
    "line_item_id": "l1",
    "sku": "s1",
    "quantity": 1,
    "unit_price": 1000,
    "is_refunded": False,
    "inserted_at": dt.datetime(2024, 1, 2),
}


@pytest.fixture(scope="session")
def make(spark):
    """Rows of a declared table from dicts; columns not given are null (orders have defaults)."""

    def build(table, *rows, schema=None):
        schema = schema or SCHEMAS[table]
        base = ORDER_DEFAULTS if table == "ec_shopify_orders" else {}
        data = [tuple({**base, **r}.get(f) for f in schema.fieldNames()) for r in rows]
        nullable = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
        return spark.createDataFrame(data, nullable)

    return build


def rows(df, *cols):
    """Rows as tuples in a stable order."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


D = dt.date.fromisoformat
T = dt.datetime.fromisoformat
