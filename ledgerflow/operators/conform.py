"""Common models across vendors.

Two vendors per domain deliver different record shapes; each is mapped to one common
shape and the two are unioned by name. Only five example mappings are documented for the
reference (IN_TRANSIT -> shipped, P1 -> urgent, on_hold -> pending, cents -> decimal,
epoch -> timestamp); the remaining value maps below are our design choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import split_nonempty

# Fixed values (design choice, extending the documented examples): cart order state -> status.
ORDER_STATES = [
    ("AWAITING_PAYMENT", "pending"),
    ("FULFILLED", "paid"),
    ("IN_TRANSIT", "shipped"),
    ("COMPLETE", "delivered"),
    ("VOIDED", "cancelled"),
    ("RETURNED", "refunded"),
]
# Fixed values (design choice): helpline urgency -> ticket priority.
URGENCY_PRIORITIES = [("P1", "urgent"), ("P2", "high"), ("P3", "normal"), ("P4", "low")]
# Fixed values (design choice): helpline case state -> ticket status.
CASE_STATES = [("new", "open"), ("open", "open"), ("on_hold", "pending"), ("resolved", "solved"), ("closed", "closed")]


def value_map(col: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal map lookup; unknown codes stay NULL (visible to accepted_values checks)."""
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])[col]


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) == "", F.lit(None)).otherwise(col)


def yes_no(col: Column) -> Column:
    return F.when(col == "Y", F.lit(True)).when(col == "N", F.lit(False))


def cents(col: Column) -> Column:
    return (col.cast("decimal(18,0)") / F.lit(100)).cast("decimal(14,2)")


def vget(col: str, path: str, dtype: str = "string") -> Column:
    return F.variant_get(F.col(col), path, dtype)


def common_customers(shopfront: DataFrame, cartwheel: DataFrame) -> DataFrame:
    """Struct address vs flat columns; first + last name; '' -> NULL; Y/N -> boolean;
    epoch seconds -> timestamp."""
    a = shopfront.select(
        F.lit("shopfront").alias("source"),
        F.col("id").cast("string").alias("customer_id"),
        F.col("email"),
        F.col("name").alias("full_name"),
        F.col("tier"),
        F.col("marketing_opt_in").alias("marketing_opt_in"),
        vget("address", "$.city").alias("city"),
        vget("address", "$.country").alias("country"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.lit(False).alias("is_deleted"),
    )
    b = cartwheel.select(
        F.lit("cartwheel").alias("source"),
        F.col("customerId").cast("string").alias("customer_id"),
        F.col("emailAddress").alias("email"),
        F.concat_ws(" ", blank_to_null(F.col("firstName")), blank_to_null(F.col("lastName"))).alias("full_name"),
        F.lower(blank_to_null(F.col("loyaltyTier"))).alias("tier"),
        yes_no(F.col("marketingConsent")).alias("marketing_opt_in"),
        blank_to_null(F.col("addrCity")).alias("city"),
        blank_to_null(F.col("addrCountry")).alias("country"),
        F.timestamp_seconds(F.col("created")).alias("created_at"),
        F.timestamp_seconds(F.col("modified")).alias("updated_at"),
        F.coalesce(F.col("isDeleted"), F.lit(False)).alias("is_deleted"),
    )
    return a.unionByName(b)


def common_orders(shopfront: DataFrame, cartwheel: DataFrame) -> DataFrame:
    """Dollars vs integer cents; cart order states mapped to the common status."""
    a = shopfront.select(
        F.lit("shopfront").alias("source"),
        F.col("id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("status"),
        F.col("currency"),
        F.col("total").cast("decimal(14,2)").alias("total"),
        F.col("placed_at").cast("timestamp").alias("placed_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.lit(False).alias("is_deleted"),
    )
    b = cartwheel.select(
        F.lit("cartwheel").alias("source"),
        F.col("orderId").cast("string").alias("order_id"),
        F.col("customerId").cast("string").alias("customer_id"),
        value_map(F.col("orderState"), ORDER_STATES).alias("status"),
        F.col("currencyCode").alias("currency"),
        cents(F.col("totalCents")).alias("total"),
        F.timestamp_seconds(F.col("placed")).alias("placed_at"),
        F.timestamp_seconds(F.col("modified")).alias("updated_at"),
        F.coalesce(F.col("isDeleted"), F.lit(False)).alias("is_deleted"),
    )
    return a.unionByName(b)


def common_order_lines(shopfront_orders: DataFrame, cartwheel_items: DataFrame) -> DataFrame:
    """Embedded ``line_items`` (position = line number) vs a child table."""
    items = shopfront_orders.select(
        F.col("id").cast("string").alias("order_id"),
        F.posexplode(F.col("line_items").cast("array<variant>")).alias("pos", "item"),
    )
    a = items.select(
        F.lit("shopfront").alias("source"),
        "order_id",
        (F.col("pos") + 1).cast("int").alias("line_number"),
        F.variant_get("item", "$.sku", "string").alias("sku"),
        F.variant_get("item", "$.quantity", "bigint").alias("quantity"),
        F.variant_get("item", "$.unit_price", "decimal(14,2)").alias("unit_price"),
    )
    b = cartwheel_items.select(
        F.lit("cartwheel").alias("source"),
        F.col("orderId").cast("string").alias("order_id"),
        F.lit(None).cast("int").alias("line_number"),
        F.col("productCode").alias("sku"),
        F.col("quantity").cast("bigint").alias("quantity"),
        cents(F.col("unitPriceCents")).alias("unit_price"),
    )
    return a.unionByName(b)


def common_tickets(ticketdesk: DataFrame, helpline: DataFrame) -> DataFrame:
    """Nested requester vs email only; P1.. urgency -> priority; case states mapped
    (on_hold -> pending); ';'-joined labels -> array; minutes -> hours; tombstones out."""
    a = ticketdesk.select(
        F.lit("ticketdesk").alias("source"),
        F.col("id").cast("string").alias("ticket_id"),
        F.col("subject"),
        F.col("status"),
        F.col("priority"),
        vget("requester", "$.email").alias("requester_email"),
        F.col("assignee_id").cast("string").alias("assignee_id"),
        F.col("tags").cast("array<string>").alias("tags"),
        F.col("time_spent_hours").cast("double").alias("hours"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.col("modified_at").cast("timestamp").alias("updated_at"),
    )
    live = helpline.filter(~F.coalesce(F.col("deleted"), F.lit(False)))
    b = live.select(
        F.lit("helpline").alias("source"),
        F.col("case_number").cast("string").alias("ticket_id"),
        F.col("title").alias("subject"),
        value_map(F.col("state"), CASE_STATES).alias("status"),
        value_map(F.col("urgency"), URGENCY_PRIORITIES).alias("priority"),
        vget("contact", "$.email").alias("requester_email"),
        vget("owner", "$.staff_id").alias("assignee_id"),
        split_nonempty(F.coalesce(F.col("labels"), F.lit("")), ";").alias("tags"),
        (F.col("effort_minutes") / F.lit(60.0)).alias("hours"),
        F.col("opened_at").cast("timestamp").alias("created_at"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )
    return a.unionByName(b)


def common_agents(ticketdesk_agents: DataFrame, helpline_staff: DataFrame) -> DataFrame:
    """Boolean ``active`` vs a status word."""
    a = ticketdesk_agents.select(
        F.lit("ticketdesk").alias("source"),
        F.col("id").cast("string").alias("agent_id"),
        F.col("name"),
        F.col("email"),
        F.col("team"),
        F.col("active").cast("boolean").alias("is_active"),
    )
    b = helpline_staff.select(
        F.lit("helpline").alias("source"),
        F.col("staff_id").cast("string").alias("agent_id"),
        F.col("display_name").alias("name"),
        F.col("email"),
        F.col("group").alias("team"),
        (F.col("status") == "active").alias("is_active"),
    )
    return a.unionByName(b)
