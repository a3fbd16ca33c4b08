"""Rules over SQL text, what accepted texts return, and what they would scan."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import sqltext
from tidemark.plans.guarded import GuardError
from tidemark.sources import catalog, lake

TX = "lake.raw.transactions"
ACCEPTED = [
    f"SELECT count(*) FROM {TX} WHERE dt = '2026-09-15' LIMIT 1",
    "SELECT dt, gmv_rupees FROM lake.analytics.daily_gmv WHERE dt BETWEEN '2026-09-01' AND '2026-09-07' ORDER BY dt LIMIT 10",
    f"SELECT m.category, count(*) n FROM {TX} t JOIN lake.raw.merchants m ON m.merchant_id = t.merchant_id "
    "WHERE t.dt = '2026-09-14' GROUP BY m.category ORDER BY n DESC LIMIT 20",
    "WITH x AS (SELECT merchant_id, sum(txn_count) n FROM lake.curated.daily_merchant_metrics WHERE dt >= '2026-09-01' "
    "GROUP BY 1) SELECT * FROM x LIMIT 5",
    "SELECT city, count(*) FROM lake.raw.users GROUP BY city LIMIT 20",
    f"SELECT dt FROM {TX} WHERE dt IN ('2026-09-01', '2026-09-02') AND status = 'FAILED' LIMIT 10",
    "SELECT * FROM lake.raw.refunds WHERE dt = '2026-09-01' LIMIT 5",
    "SELECT * FROM lake.analytics.merchant_leaderboard LIMIT 5",
    "SELECT count(*) FROM lake.raw.users LIMIT 1;",
    f"SELECT status FROM {TX} WHERE DATE '2026-09-01' <= dt AND (dt < cast('2026-09-02' AS string)) LIMIT 1",
    f"SELECT dt FROM {TX} WHERE dt = 'a' UNION ALL SELECT dt FROM lake.raw.refunds WHERE dt = 'b' LIMIT 3",
    f"SELECT city FROM lake.raw.users u WHERE EXISTS (SELECT 1 FROM {TX} t WHERE t.dt = 'a' AND t.payer_user_id = u.user_id) LIMIT 3",
    f"SELECT t.status FROM lake.raw.merchants m LEFT JOIN {TX} t ON t.merchant_id = m.merchant_id AND t.dt = 'a' LIMIT 3",
]
REFUSED = [
    *(
        (text, "SELECT")
        for text in (
            "DROP TABLE lake.raw.users",
            f"DELETE FROM {TX}",
            "INSERT INTO lake.raw.users VALUES (1)",
            "CREATE TABLE x AS SELECT 1",
            "SHOW TABLES FROM lake.raw",
            "CALL lake.system.sync('raw')",
            "EXPLAIN SELECT 1",
            "SET spark.sql.ansi.enabled = false",
            "SELECT x FROM range(10) LIMIT 1",
            "SELECT explode(array(1)) FROM lake.raw.merchants LATERAL VIEW explode(array(1)) t AS x LIMIT 1",
        )
    ),
    ("SELECT 1 LIMIT 1; DROP TABLE lake.raw.users", "exactly one"),
    ("SELEC nonsense FROM", "exactly one"),
    (f"SELECT count(*) FROM {TX} WHERE dt = '2026-09-15'", "LIMIT"),
    (f"SELECT count(*) FROM {TX} WHERE dt = '2026-09-15' LIMIT 1 + 1", "LIMIT"),
    (f"SELECT dt FROM {TX} WHERE dt = 'a' LIMIT ALL", "LIMIT"),
    (f"SELECT * FROM (SELECT dt FROM {TX} WHERE dt = 'a' LIMIT 5) x", "LIMIT"),
    (f"SELECT dt FROM {TX} WHERE dt = '2026-09-15' LIMIT 100000", "exceeds"),
    (f"SELECT count(*) FROM {TX} LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE created_at >= TIMESTAMP '2026-09-15 00:00:00' LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE dt = '2026-09-15' OR status = 'FAILED' LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE NOT (dt = '2026-09-15') LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE substr(dt, 1, 7) = '2026-09' LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE dt = status LIMIT 1", "partitioned"),
    (f"SELECT count(*) FROM {TX} WHERE dt IN ('a', status) LIMIT 1", "partitioned"),
    (f"SELECT * FROM (SELECT status FROM {TX}) t LIMIT 5", "partitioned"),
    (f"SELECT * FROM (SELECT status, dt FROM {TX}) t WHERE dt = 'a' LIMIT 5", "partitioned"),
    (f"WITH x AS (SELECT status FROM {TX}) SELECT * FROM x LIMIT 5", "partitioned"),
    (f"SELECT dt FROM {TX} WHERE dt = 'a' UNION ALL SELECT dt FROM lake.raw.refunds LIMIT 3", "partitioned"),
    (f"SELECT city FROM lake.raw.users WHERE user_id IN (SELECT payer_user_id FROM {TX}) LIMIT 3", "partitioned"),
    (f"SELECT a.status FROM {TX} a JOIN lake.raw.refunds b ON a.txn_id = b.txn_id WHERE a.dt = 'x' LIMIT 3", "partitioned"),
    (f"SELECT t.status FROM {TX} t LEFT JOIN lake.raw.merchants m ON t.dt = 'a' LIMIT 3", "partitioned"),
    ("SELECT * FROM lake.analytics.daily_gmv LIMIT 5", "partitioned"),
    ("SELECT x.d FROM lake.raw.refunds AS x(a, b, c, d, e, dt, f, g) WHERE dt = 'a' LIMIT 5", "by position"),
    *((f"SELECT {c} FROM lake.raw.users LIMIT 5", "PII") for c in ("phone", "email", "VPA", "full_name", "users.phone")),
    (f"SELECT upi_ref FROM {TX} WHERE dt = '2026-09-15' LIMIT 5", "PII"),
    ("SELECT city FROM lake.raw.users WHERE phone = 'x' LIMIT 5", "PII"),
    ("SELECT city FROM lake.raw.users ORDER BY email LIMIT 5", "PII"),
    ("SELECT p FROM (SELECT lower(phone) AS p FROM lake.raw.users) LIMIT 5", "PII"),
    ("SELECT a.city FROM lake.raw.users a JOIN lake.raw.users b USING (phone) LIMIT 5", "PII"),
    ("SELECT city FROM lake.raw.users NATURAL JOIN lake.raw.merchants LIMIT 5", "NATURAL"),
    ("SELECT x.c FROM lake.raw.users AS x(a, b, c, d, e, f, g, h, i) LIMIT 5", "by position"),
    ("SELECT * FROM lake.raw.users LIMIT 5", "SELECT *"),
    (f"SELECT t.* FROM {TX} t WHERE t.dt = '2026-09-15' LIMIT 5", "SELECT *"),
    ("SELECT to_json(struct(*)) FROM lake.raw.users LIMIT 5", "SELECT *"),
    ("SELECT 1, 'a', 'b', 'c', 'd', 'e', 'f', 'g', 'h' UNION ALL TABLE lake.raw.users LIMIT 5", "SELECT *"),
    ("SELECT 1 FROM lake.raw.secrets LIMIT 1", "allow-list"),
    ("SELECT 1 FROM lake.information_schema.columns LIMIT 1", "allow-list"),
    ("SELECT 1 FROM transactions LIMIT 1", "qualified"),
    ("SELECT 1 FROM system.runtime.queries LIMIT 1", "qualified"),
    ("SELECT 1 FROM parquet.`/etc` LIMIT 1", "qualified"),
    ("WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a LIMIT 1", "qualified"),
    ("SELECT java_method('java.lang.System', 'exit', 0) LIMIT 1", "not allowed"),
]


@pytest.mark.parametrize("text", ACCEPTED)
def test_accepted(spark, text):
    assert sqltext.validate(spark, text).errors == []


@pytest.mark.parametrize("text,reason", REFUSED)
def test_refused_with_the_reason(spark, text, reason):
    errors = sqltext.validate(spark, text).errors
    assert any(reason in e for e in errors), errors


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Transactions over four days as an analysed and as an unknown table; merchants analysed."""
    root = tmp_path_factory.mktemp("sqltext")
    day = datetime.datetime(2024, 1, 1)
    rows = [
        (i, str(i), i % 7, i % 3, 100 * i, ("SUCCESS", "FAILED")[i % 2], None, day, day, f"2024-01-0{1 + i % 4 * i % 4}")
        for i in range(200)
    ]
    tx = catalog.conform(spark.createDataFrame(rows, catalog.struct_type("transactions")), "transactions")
    merchants = [(i, f"m{i}", ("food", "toys")[i % 2], "x", "LOW", "1", day, day, "2024-01-01") for i in range(3)]
    shops = catalog.conform(spark.createDataFrame(merchants, catalog.struct_type("merchants")), "merchants")
    for name, df in (("transactions", tx), ("merchants", shops)):
        lake.write_partition_overwrite(df, f"{root}/{name}")
        lake.register_external_table(spark, f"text_{name}", f"{root}/{name}", catalog.struct_type(name))
    lake.register_external_table(
        spark, "text_unknown", f"{root}/transactions", catalog.struct_type("transactions"), analyze=False
    )
    yield {"raw.transactions": spark.table("text_transactions"), "raw.merchants": spark.table("text_merchants")}, rows
    for name in ("text_transactions", "text_merchants", "text_unknown"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_accepted_text_runs(spark, tables):
    frames, rows = tables
    text = """WITH f AS (SELECT merchant_id, amount_paise FROM lake.raw.transactions
                         WHERE transactions.dt IN ('2024-01-01', '2024-01-02') AND status = 'FAILED')
              SELECT m.category, sum(f.amount_paise) AS paise FROM f JOIN `lake`.raw.`merchants` m
              ON m.merchant_id = f.merchant_id GROUP BY m.category ORDER BY 1 LIMIT 10"""
    out = {r["category"]: r["paise"] for r in sqltext.guarded_sql(spark, text, frames).collect()}
    expected = {}
    for r in rows:
        if r[9] in ("2024-01-01", "2024-01-02") and r[5] == "FAILED":
            kind = ("food", "toys")[r[3] % 2]
            expected[kind] = expected.get(kind, 0) + r[4]
    assert out == expected
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("raw_transactions_")]


def test_a_text_that_does_not_resolve_is_refused(spark, tables):
    text = "SELECT nope FROM lake.raw.merchants LIMIT 1"
    with pytest.raises(GuardError, match="nope"):
        sqltext.guarded_sql(spark, text, tables[0])


def scan(spark, where, frames):
    report = sqltext.validate(spark, f"SELECT count(*) FROM {TX} WHERE {where} LIMIT 1")
    assert report.ok
    return sqltext.planned_scans(sqltext.planned(spark, report, frames))


@pytest.mark.parametrize(
    "where,days",
    [
        ("dt = '2024-01-02'", {"2024-01-02"}),
        ("dt BETWEEN '2024-01-01' AND '2024-01-02'", {"2024-01-01", "2024-01-02"}),
        ("dt IN ('2024-01-03', '2030-01-01')", {"2024-01-03"}),
        ("dt = '2030-01-01'", set()),
        ("dt >= '2020-01-01' AND status = 'FAILED' AND amount_paise > 5", {f"2024-01-0{i}" for i in range(1, 5)}),
    ],
)
def test_planner_counts_pruned_partitions(spark, tables, where, days):
    frames, rows = tables
    found = scan(spark, where, frames)
    present = {r[9] for r in rows} & days
    expected = sum(r[9] in days for r in rows)
    if not found:
        assert expected == 0  # the optimizer has dropped the scan
    else:
        assert [(s.partitions, s.rows) for s in found] == [(len(present), expected)]


def test_joined_scans_add_up_and_over_the_limit(spark, tables):
    frames, rows = tables
    text = (
        f"SELECT m.category, count(*) FROM {TX} t JOIN lake.raw.merchants m ON m.merchant_id = t.merchant_id "
        "WHERE t.dt >= '2024-01-01' GROUP BY 1 LIMIT 5"
    )
    report = sqltext.validate(spark, text)
    scans = sqltext.planned_scans(sqltext.planned(spark, report, frames))
    assert sum(s.rows for s in scans) == len(rows) + 3
    with pytest.raises(GuardError, match="exceeds the limit of 100"):
        sqltext.guarded_sql(spark, text, frames, max_scan_rows=100)


def test_unknown_statistics_fail_closed(spark, tables):
    frames = {"raw.transactions": spark.table("text_unknown")}
    text = f"SELECT count(*) FROM {TX} WHERE dt = '2024-01-01' LIMIT 1"
    with pytest.raises(GuardError, match="ANALYZE"):
        sqltext.guarded_sql(spark, text, frames)
    plain = {"raw.transactions": spark.table("text_unknown").filter("amount_paise >= 0")}
    with pytest.raises(GuardError, match="ANALYZE"):
        sqltext.guarded_sql(spark, text, plain)
    assert sqltext.guarded_sql(spark, text, frames, max_scan_rows=None).count() == 1


def test_nothing_is_planned_when_a_rule_fails(spark):
    with pytest.raises(GuardError, match="SELECT"):
        sqltext.guarded_sql(spark, "DROP TABLE lake.raw.users", {})


def test_estimates_of_several_texts(spark, tables):
    frames, rows = tables
    texts = {
        "day": f"SELECT count(*) FROM {TX} WHERE dt = '2024-01-01' LIMIT 1",
        "all": f"SELECT count(*) FROM {TX} WHERE dt >= '2024-01-01' LIMIT 1",
        "bad": f"SELECT count(*) FROM {TX} LIMIT 1",
    }
    out = {r["request_id"]: r for r in sqltext.planned_estimates(spark, texts, frames, 150).collect()}
    assert out["day"]["estimated_rows"] == sum(r[9] == "2024-01-01" for r in rows) and out["day"]["verdict"] == "ok"
    assert out["all"]["estimated_rows"] == len(rows) and out["all"]["verdict"] == "over_limit"
    assert out["bad"]["verdict"] == "refused"
