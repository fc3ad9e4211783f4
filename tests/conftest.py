import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ordermill.session import get_session

    shared = str(tmp_path_factory.mktemp("shared"))
    s = get_session("ordermill-tests", "local[4]", spark__checkpoint__dir=shared, spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def one(spark):
    """Evaluate an expression over one column of values."""
    from pyspark.sql import functions as F

    def run(values, make, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]

    return run


ORDER_SCHEMA = (
    "order_id string, customer_name string, customer_email string, product string, product_category string, quantity int, price double, "
    "discount double, total_amount double, order_date string, store_location string, source string"
)


@pytest.fixture
def sample_orders(spark):
    return spark.createDataFrame(
        [
            ("ORD-2024-001", "John Doe", "john.doe@email.com", "iPhone 15", "Electronics", 1, 999.99, 0.0, 999.99, "2024-01-15", "New York", "website"),
            ("ORD-2024-002", "Jane Smith", "jane@email.com", "MacBook Pro", "Electronics", 1, 1999.99, 100.0, 1899.99, "2024-01-16", "Los Angeles", "store"),
            ("ORD-2024-003", "Bob Johnson", "bob@email.com", "AirPods Pro", "Electronics", 2, 249.99, 0.0, 499.98, "2024-01-17", "Chicago", "mobile_app"),
        ],
        ORDER_SCHEMA,
    )


@pytest.fixture
def invalid_orders(spark):
    return spark.createDataFrame(
        [
            ("INVALID-ID", "", "invalid-email", "iPhone 15", "Electronics", -1, -100.0, 0.0, -100.0, "2025-12-31", "New York", "website"),
            ("ORD-2024-004", "Alice", "alice@email.com", "", "Electronics", 2000, 0.0, 1000.0, 999.0, "2010-01-01", "Chicago", "store"),
        ],
        ORDER_SCHEMA,
    )
