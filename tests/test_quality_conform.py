import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import conform, quality


def test_checks_summary_and_failing_rows(spark):
    orders = spark.createDataFrame([(1, "F", 10), (2, "X", 11), (2, None, None)], "id int, status string, cust int")
    cust = spark.createDataFrame([(10,), (12,)], "cust int")
    tables = {"orders": orders, "customers": cust}
    checks = [
        quality.Check("unique_id", "orders", "unique", ("id",)),
        quality.Check("not_null_status", "orders", "not_null", ("status",)),
        quality.Check("accepted_status", "orders", "accepted_values", ("status",), {"values": ["F", "O"]}, "warn"),
        quality.Check("orders_customers", "orders", "relationships", ("cust",), {"to": "customers", "field": "cust"}, "warn"),
        quality.Check("combo", "orders", "unique_combination", ("id", "cust")),
    ]
    got = {r["check"]: (r["failures"], r["status"]) for r in quality.run_checks(tables, checks).collect()}
    assert got == {
        "unique_id": (1, "fail"),
        "not_null_status": (1, "fail"),
        "accepted_status": (1, "warn"),  # NULL passes accepted_values
        "orders_customers": (1, "warn"),  # NULL keys pass relationships
        "combo": (0, "pass"),
    }


def test_freshness_and_contract(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, tzinfo=dt.UTC),)], "_loaded_at timestamp")
    row = quality.freshness(df, "_loaded_at", dt.datetime(2024, 1, 3, tzinfo=dt.UTC)).collect()[0]
    assert row.age_hours == 48 and row.is_stale
    contract = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    ok = spark.createDataFrame([(1, "x")], "a int, b string")
    assert quality.assert_contract(ok, contract) is ok
    with pytest.raises(quality.ContractError, match="a: type mismatch"):
        quality.assert_contract(spark.createDataFrame([(1, "x")], "a bigint, b string"), contract)
    with pytest.raises(quality.ContractError, match="b: missing"):
        quality.assert_contract(spark.createDataFrame([(1,)], "a int"), contract)


def test_schema_drift_and_set_equality(spark):
    a = spark.createDataFrame([("x", "integer", None, False), ("y", "string", None, True)], "path string, type string, format string, nullable boolean")
    b = spark.createDataFrame([("x", "number", None, False), ("y", "string", None, True), ("z", "null", None, True)], "path string, type string, format string, nullable boolean")
    assert sorted(r.path for r in quality.schema_drift(a, b).collect()) == ["x", "z"]
    assert quality.set_equal(a, a) and not quality.set_equal(a, b)


def _v(spark, rows, ddl, variant_cols):
    df = spark.createDataFrame(rows, ddl)
    for c in variant_cols:
        df = df.withColumn(c, F.parse_json(c))
    return df


def test_common_customers_and_orders(spark):
    shop = _v(spark, [("s1", "a@x", "Ann", None, True, '{"city":"Oslo","country":"NO"}', "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z")],
              "id string, email string, name string, tier string, marketing_opt_in boolean, address string, created_at string, updated_at string", ["address"])
    cart = spark.createDataFrame([(7, "Bo", "", "b@x", "", "Y", "", "", 1704067200, 1704153600, True)],
                                 "customerId bigint, firstName string, lastName string, emailAddress string, loyaltyTier string, "
                                 "marketingConsent string, addrCity string, addrCountry string, created bigint, modified bigint, isDeleted boolean")
    rows = {r.source: r for r in conform.common_customers(shop, cart).collect()}
    assert rows["shopfront"].city == "Oslo"
    c = rows["cartwheel"]
    assert (c.full_name, c.tier, c.marketing_opt_in, c.city, c.is_deleted) == ("Bo", None, True, None, True)
    assert c.created_at == dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([(1, 2, "IN_TRANSIT", "EUR", 12345, 1704067200, 1704067200, False)],
                                   "orderId bigint, customerId bigint, orderState string, currencyCode string, totalCents bigint, placed bigint, modified bigint, isDeleted boolean")
    shop_o = spark.createDataFrame([("a", "c", "paid", "USD", 10.0, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z")],
                                   "id string, customer_id string, status string, currency string, total double, placed_at string, updated_at string")
    out = {r.source: r for r in conform.common_orders(shop_o, orders).collect()}
    assert out["cartwheel"].status == "shipped" and float(out["cartwheel"].total) == 123.45


def test_common_tickets_agents_and_lines(spark):
    desk = _v(spark, [(1, "s", "open", "urgent", '{"name":"n","email":"e@x"}', 5, '["a","b"]', 1.5, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z")],
              "id bigint, subject string, status string, priority string, requester string, assignee_id bigint, tags string, time_spent_hours double, created_at string, modified_at string",
              ["requester", "tags"])
    help_ = _v(spark, [("C1", "t", "on_hold", "P1", '{"email":"h@x"}', '{"staff_id":"S9","name":"x"}', "a;;b;", 90, "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00Z", False),
                       ("C2", None, None, None, None, None, None, None, None, "2024-01-01T00:00:00Z", True)],
               "case_number string, title string, state string, urgency string, contact string, owner string, labels string, effort_minutes bigint, opened_at string, updated_at string, deleted boolean",
               ["contact", "owner"])
    rows = {r.source: r for r in conform.common_tickets(desk, help_).collect()}
    assert len(rows) == 2  # the tombstone is filtered out
    h = rows["helpline"]
    assert (h.status, h.priority, h.tags, h.hours, h.assignee_id) == ("pending", "urgent", ["a", "b"], 1.5, "S9")
    assert h.created_at == dt.datetime(2024, 1, 1, 0, 0)
    agents = conform.common_agents(
        spark.createDataFrame([(1, "a", "e", "t", True)], "id bigint, name string, email string, team string, active boolean"),
        spark.createDataFrame([("S1", "b", "f", "Tier 1", "deactivated")], "staff_id string, display_name string, email string, group string, status string"),
    )
    assert sorted(r.is_active for r in agents.collect()) == [False, True]
    lines = conform.common_order_lines(
        _v(spark, [("o1", '[{"sku":"x","quantity":2,"unit_price":3.5},{"sku":"y","quantity":1,"unit_price":1}]')], "id string, line_items string", ["line_items"]),
        spark.createDataFrame([(1, 9, "p", 3, 250)], "orderItemId bigint, orderId bigint, productCode string, quantity bigint, unitPriceCents bigint"),
    )
    got = sorted((r.source, r.line_number, r.sku, float(r.unit_price)) for r in lines.collect())
    assert got == [("cartwheel", None, "p", 2.5), ("shopfront", 1, "x", 3.5), ("shopfront", 2, "y", 1.0)]
