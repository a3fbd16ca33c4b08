"""The declared schema of every table and view: the single source for types, keys, partitions and PII tags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARK_TYPES = {
    "bigint": T.LongType(),
    "integer": T.IntegerType(),
    "varchar": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
}

# Type families used for drift detection: width changes inside a family are not drift.
_FAMILIES = (
    (T.IntegralType, "int"),
    ((T.FractionalType, T.DecimalType), "float"),
    ((T.StringType, T.VarcharType, T.CharType), "str"),
    ((T.TimestampType, T.TimestampNTZType), "ts"),
)


def family(kind: T.DataType) -> str:
    """Type family of a live column, by class and not by spelling."""
    return next((name for types, name in _FAMILIES if isinstance(kind, types)), kind.simpleString())


DECLARED_FAMILY = {"bigint": "int", "integer": "int", "varchar": "str", "timestamp": "ts", "double": "float"}


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    description: str
    pii: bool = False


@dataclass(frozen=True)
class Table:
    name: str
    layer: str  # raw | curated | analytics
    description: str
    columns: tuple[Column, ...]
    pk: str | None = None
    partition_column: str | None = None
    partition_filter_required: bool = False
    kind: str = field(default="table")

    @property
    def key(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def pii_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.pii]

    @property
    def safe_columns(self) -> list[Column]:
        return [c for c in self.columns if not c.pii]

    @property
    def not_null_columns(self) -> list[str]:
        """Primary key, both row timestamps, then every foreign key."""
        foreign = [c.name for c in self.columns if c.name.endswith("_id") and c.name != self.pk]
        return [self.pk, "created_at", "updated_at", *foreign]


def _raw(name, pk, description, columns, partition_filter_required=False) -> Table:
    stamps = (
        Column("created_at", "timestamp", "Creation time (UTC); its date is the dt partition"),
        Column("updated_at", "timestamp", "Last change of the row; drives the incremental window"),
    )
    dt = Column("dt", "varchar", "Partition: creation date as YYYY-MM-DD text")
    return Table(name, "raw", description, (*columns, *stamps, dt), pk, "dt", partition_filter_required)


# Table names, column names, types, keys, partition columns and PII tags of the data model.
_TABLES = (
    _raw(
        "users",
        "user_id",
        "Registered payers, one row each. Attributes such as KYC level change after sign-up.",
        (
            Column("user_id", "bigint", "User key"),
            Column("full_name", "varchar", "Legal name", pii=True),
            Column("phone", "varchar", "Mobile number", pii=True),
            Column("email", "varchar", "Mail address", pii=True),
            Column("vpa", "varchar", "Virtual payment address", pii=True),
            Column("city", "varchar", "Home city"),
            Column("kyc_status", "varchar", "KYC level: MIN_KYC, FULL_KYC or REJECTED"),
        ),
    ),
    _raw(
        "merchants",
        "merchant_id",
        "Businesses that accept payments, one row each.",
        (
            Column("merchant_id", "bigint", "Merchant key"),
            Column("merchant_name", "varchar", "Trading name"),
            Column("category", "varchar", "Line of business"),
            Column("city", "varchar", "City of operation"),
            Column("risk_tier", "varchar", "Risk class: LOW, MEDIUM or HIGH"),
            Column("contact_phone", "varchar", "Contact number", pii=True),
        ),
    ),
    _raw(
        "transactions",
        "txn_id",
        "Payment attempts from a user to a merchant. A PENDING attempt may resolve days later.",
        (
            Column("txn_id", "bigint", "Payment key"),
            Column("upi_ref", "varchar", "12-digit network reference", pii=True),
            Column("payer_user_id", "bigint", "Paying user"),
            Column("merchant_id", "bigint", "Receiving merchant"),
            Column("amount_paise", "bigint", "Amount in paise, 100 paise are one rupee"),
            Column("status", "varchar", "PENDING, SUCCESS or FAILED"),
            Column("failure_code", "varchar", "Reason code of a FAILED payment, else null"),
        ),
        partition_filter_required=True,
    ),
    _raw(
        "refunds",
        "refund_id",
        "Refunds raised against successful payments, usually days after the payment.",
        (
            Column("refund_id", "bigint", "Refund key"),
            Column("txn_id", "bigint", "Refunded payment"),
            Column("amount_paise", "bigint", "Refunded amount in paise"),
            Column("status", "varchar", "PENDING, PROCESSED or REJECTED"),
            Column("reason", "varchar", "Why the refund was raised"),
        ),
        partition_filter_required=True,
    ),
    Table(
        "daily_merchant_metrics",
        "curated",
        "Payment counts, successful amount and refunds per merchant and payment day.",
        (
            Column("merchant_id", "bigint", "Merchant key"),
            Column("merchant_name", "varchar", "Trading name"),
            Column("category", "varchar", "Line of business"),
            Column("txn_count", "bigint", "Payment attempts"),
            Column("success_count", "bigint", "SUCCESS payments"),
            Column("failed_count", "bigint", "FAILED payments"),
            Column("pending_count", "bigint", "PENDING payments"),
            Column("success_amount_paise", "bigint", "Amount of the SUCCESS payments"),
            Column("refund_count", "bigint", "Refunds that were not REJECTED, on the payment's day"),
            Column("refund_amount_paise", "bigint", "Amount of those refunds"),
            Column("dt", "varchar", "Partition: payment date as YYYY-MM-DD text"),
        ),
        partition_column="dt",
        partition_filter_required=True,
    ),
    Table(
        "user_cohorts",
        "curated",
        "Active payers per sign-up week and number of weeks since sign-up.",
        (
            Column("weeks_since_signup", "integer", "Whole weeks from sign-up week to activity week"),
            Column("cohort_size", "bigint", "Users that signed up in the week"),
            Column("active_users", "bigint", "Users of the cohort with a SUCCESS payment in that week"),
            Column("cohort_week", "varchar", "Partition: Monday of the sign-up week as YYYY-MM-DD text"),
        ),
        partition_column="cohort_week",
    ),
    Table(
        "daily_gmv",
        "analytics",
        "Attempts, successes, successful rupees and success rate per day.",
        (
            Column("dt", "varchar", "Payment date"),
            Column("txn_count", "bigint", "Payment attempts"),
            Column("success_count", "bigint", "SUCCESS payments"),
            Column("gmv_rupees", "double", "Successful amount in rupees"),
            Column("success_rate_pct", "double", "Successes per hundred attempts"),
        ),
        partition_column="dt",
        partition_filter_required=True,
        kind="view",
    ),
    Table(
        "merchant_leaderboard",
        "analytics",
        "Attempts, successful rupees, failure rate and refund rate per merchant over all days.",
        (
            Column("merchant_id", "bigint", "Merchant key"),
            Column("merchant_name", "varchar", "Trading name"),
            Column("category", "varchar", "Line of business"),
            Column("txn_count", "bigint", "Payment attempts"),
            Column("gmv_rupees", "double", "Successful amount in rupees"),
            Column("failure_rate_pct", "double", "Failures per hundred attempts"),
            Column("refund_rate_pct", "double", "Refunds per hundred successes"),
        ),
        kind="view",
    ),
    Table(
        "failure_reasons",
        "analytics",
        "Failed payments per day and reason code.",
        (
            Column("dt", "varchar", "Payment date"),
            Column("failure_code", "varchar", "Reason code"),
            Column("failed_count", "bigint", "FAILED payments"),
        ),
        partition_column="dt",
        partition_filter_required=True,
        kind="view",
    ),
    Table(
        "retention_weekly",
        "analytics",
        "Share of a sign-up cohort that is active, per week since sign-up.",
        (
            Column("cohort_week", "varchar", "Monday of the sign-up week"),
            Column("weeks_since_signup", "integer", "Weeks since sign-up"),
            Column("cohort_size", "bigint", "Users in the cohort"),
            Column("retention_pct", "double", "Active users per hundred of the cohort"),
        ),
        partition_column="cohort_week",
        kind="view",
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}


def table(name: str) -> Table:
    return TABLES[name]


def struct_type(name: str) -> T.StructType:
    """Typed schema of a table, partition column last, the PII tag kept as field metadata."""
    return T.StructType(
        [T.StructField(c.name, SPARK_TYPES[c.type], True, {"pii": c.pii}) for c in table(name).columns]
    )


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project to the declared columns, order and types; a column the frame lacks is an error."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in struct_type(name).fields]
    )


def pii_columns() -> dict[str, list[str]]:
    """Tagged columns per table, tables without any left out."""
    return {t.name: t.pii_columns for t in _TABLES if t.pii_columns}


def pii_safe_projection(df: DataFrame) -> DataFrame:
    """Drop every column whose schema metadata carries the PII tag."""
    return df.select(*[f.name for f in df.schema.fields if not f.metadata.get("pii")])
