"""Orders credited to the last message before them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_body
from ..operators.joins import horizon_flags, last_touch
from ..operators.ordered import Bucket, fill_ordered
from ..session import Stage, lazily

_CUSTOMER = ["org", "customer_id"]


def _orders_with_gap(population: DataFrame, contacts: DataFrame, bucket: Bucket | None,
                     stage: Stage) -> DataFrame:
    """Orders per contact with whole days since the customer's previous order.

    A customer with two contacts has each order twice, and the second copy
    follows the first by zero days. That is the source system's behaviour.
    """
    orders = population.select(
        "customer_id", "org", "source_system", "order_id", "order_type", "order_facility",
        F.col("order_time_utc").alias("event_time_utc"), "order_time_local",
        "order_total").distinct()
    orders = stage(orders.join(contacts, ["customer_id", "org", "source_system"]))
    contact = [c for c in contacts.columns if c not in ("customer_id", "org", "source_system")]
    gaps = fill_ordered(orders, _CUSTOMER, ["order_time_local", "order_id", *contact],
                        {"__prev": "order_time_local"}, include_current=False, bucket=bucket)
    return gaps.withColumn("time_since_last_order", F.datediff("order_time_local", "__prev")
                           ).drop("__prev")


def _credited_lines(touched: DataFrame, population: DataFrame, touch_time: str, body: str,
                    line_columns: list[str]) -> DataFrame:
    credited = touched.where(F.col(body).isNotNull()).select(
        "*", *horizon_flags(F.col("event_time_utc"), F.col(touch_time)),
        (F.col("time_since_last_order") >= 90).alias("was_lost"))
    keys = ["org", "source_system", "order_id"]
    return credited.join(population.select(*keys, *line_columns).distinct(), keys)


LINE_COLUMNS = ["order_line_id", "product_name", "product_id", "brand_name", "product_uom",
                "product_unit_count", "product_qty", "product_category_name", "product_class",
                "order_line_total"]


def sms_attribution(messages: DataFrame, campaigns: DataFrame, population: DataFrame, *,
                    line_columns: list[str] = [*LINE_COLUMNS, "category3"],
                    bucket: Bucket | None = "month", stage: Stage = lazily) -> DataFrame:
    """Order lines with the text message their customer received last before.

    ``messages``: org, to, body, date_sent, campaign_id; ``campaigns``: org,
    campaign_id, campaign_body (which replaces the message text).
    """
    contacts = (population.where(F.coalesce("phone", F.lit("")) != "")
                .select("customer_id", "org", "source_system", "phone").distinct())
    contacts = stage(contacts)
    sent = (messages.join(campaigns.select("org", "campaign_id", "campaign_body"),
                          ["org", "campaign_id"], "left")
            .withColumn("body", clean_body(F.coalesce("campaign_body", "body")))
            .withColumnRenamed("to", "phone")
            .join(contacts, ["phone", "org"])
            .select("org", "customer_id", "campaign_id", "body", "date_sent"))
    touched = last_touch(
        _orders_with_gap(population, contacts, bucket, stage), sent, _CUSTOMER,
        order_time="event_time_utc", touch_time="date_sent",
        touch_columns={"last_sms_date_sent": "date_sent", "last_sms_body": "body",
                       "last_sms_campaign_id": "campaign_id"},
        order_tie=["order_id", "phone"], touch_tie=["campaign_id", "body"], bucket=bucket,
        stage=stage)
    return _credited_lines(touched, population, "last_sms_date_sent", "last_sms_body",
                           line_columns)


def email_attribution(sent_emails: DataFrame, campaigns: DataFrame, population: DataFrame, *,
                      line_columns: list[str] = LINE_COLUMNS, bucket: Bucket | None = "month",
                      stage: Stage = lazily) -> DataFrame:
    """The same for emails. ``sent_emails``: campaign_id, email, sent_at_utc."""
    contacts = (population.where(F.col("email").isNotNull())
                .select("customer_id", "org", "source_system", "email").distinct())
    contacts = stage(contacts)
    info = {"campaign_uuid": F.col("campaign_uuid"), "img_path": F.col("email_img_path"),
            "template_id": F.col("email_template_id"),
            "subject": clean_body(F.col("email_subject")), "body": clean_body(F.col("email_body"))}
    described = campaigns.select("campaign_id", *[c.alias(n) for n, c in info.items()])
    sent = (sent_emails.join(described, "campaign_id", "left").join(contacts, "email")
            .select("org", "customer_id", "sent_at_utc", *info))
    touched = last_touch(
        _orders_with_gap(population, contacts, bucket, stage), sent, _CUSTOMER,
        order_time="event_time_utc", touch_time="sent_at_utc",
        touch_columns={"last_email_date_sent": "sent_at_utc",
                       **{f"last_email_{n}": n for n in info}},
        order_tie=["order_id", "email"], touch_tie=["campaign_uuid", "subject", "body"],
        bucket=bucket, stage=stage)
    return _credited_lines(touched, population, "last_email_date_sent", "last_email_body",
                           line_columns)
