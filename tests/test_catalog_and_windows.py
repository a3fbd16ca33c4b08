from datetime import date, datetime, timedelta, timezone

import pytest

from tidemark.operators import curated, ingest
from tidemark.sources import catalog
from tidemark.sources.oltp import jdbc_options


def test_pii_tags():
    assert catalog.pii_columns() == {
        "users": ["full_name", "phone", "email", "vpa"],
        "merchants": ["contact_phone"],
        "transactions": ["upi_ref"],
    }


def test_partition_filter_flags():
    flagged = {t.name for t in catalog.TABLES.values() if t.partition_filter_required}
    assert flagged == {"transactions", "refunds", "daily_merchant_metrics", "daily_gmv", "failure_reasons"}


def test_every_table_and_column_is_described():
    for t in catalog.TABLES.values():
        assert t.description and all(c.description for c in t.columns), t.name
        assert t.partition_column is None or t.partition_column in t.column_names


def test_schema_keeps_types_order_and_tags():
    schema = catalog.struct_type("transactions")
    assert schema.fieldNames()[-1] == "dt"
    assert schema["amount_paise"].dataType.simpleString() == "bigint"
    assert schema["created_at"].dataType.simpleString() == "timestamp_ntz"
    assert schema["upi_ref"].metadata["pii"] and not schema["status"].metadata["pii"]


def test_key_columns():
    assert catalog.table("transactions").not_null_columns == [
        "txn_id",
        "created_at",
        "updated_at",
        "payer_user_id",
        "merchant_id",
    ]


def test_safe_projection_drops_tagged_columns_only(spark):
    df = catalog.conform(spark.createDataFrame([], catalog.struct_type("users")), "users")
    assert catalog.pii_safe_projection(df).columns == ["user_id", "city", "kyc_status", "created_at", "updated_at", "dt"]


START = datetime(2026, 8, 1)


def test_run_without_interval_covers_the_last_day():
    now = datetime(2026, 9, 29, 8, 41, tzinfo=timezone.utc)
    lo, hi = ingest.resolve_window(None, None, now, START)
    assert hi == datetime(2026, 9, 29, 8, 41) and lo == hi - timedelta(days=1)


def test_overrides_win():
    bounds = datetime(2026, 9, 20), datetime(2026, 9, 21)
    assert ingest.resolve_window(None, None, datetime(2026, 9, 29), START, *bounds) == bounds


def test_first_interval_is_the_initial_load():
    lo, hi = ingest.resolve_window(START, datetime(2026, 8, 2), datetime(2026, 8, 2), START)
    assert (lo, hi) == (datetime(1970, 1, 1), datetime(2026, 8, 2))


def test_transform_window():
    assert curated.transform_window(date(2026, 9, 28)) == ("2026-09-21", "2026-09-28")
    assert curated.transform_window(date(2026, 9, 28), date(2026, 9, 1)) == ("2026-09-01", "2026-09-28")


@pytest.mark.parametrize("splits", [1, 32])
def test_jdbc_read_is_split_and_pushes_down(splits):
    options = jdbc_options("jdbc:postgresql://host/db", "transactions", "txn_id", 1, 100, splits)
    assert options["numPartitions"] == str(splits) and options["pushDownPredicate"] == "true"
