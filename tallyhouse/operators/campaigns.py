"""Message campaigns: delivery, return on sales, opt-outs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import distinct_days
from ..functions.text import clean_body
from .joins import HORIZON_HOURS
from .reshape import stack

HORIZONS = list(HORIZON_HOURS)


def campaign_delivery(messages: DataFrame, org_config: DataFrame, *, as_of: Column | None = None
                      ) -> DataFrame:
    """Per campaign: customers, texts, billed texts, price, delivery rates.

    Rolled up first per recipient, then per campaign and media kind
    (picture messages are billed at the organisation's ratio), then per
    campaign. A recipient reached with both kinds counts once in each.
    """
    group = ["campaign_id", "org", "is_mms"]
    ok = F.col("error_code").isNull()
    sent = messages.where(F.col("sent_from_messaging_service") & F.col("campaign_id").isNotNull())
    segments, price = (F.col(c).cast("double") for c in ("num_segments", "price"))
    per_recipient = sent.groupBy(*group, "to").agg(
        F.bool_or(ok).alias("reached"), F.sum(F.when(ok, segments)).alias("texts"),
        F.sum(segments).alias("texts_sent"), F.min("date_sent").alias("first_text"),
        F.max("date_sent").alias("last_text"), F.sum(price).alias("price"),
        F.max("text_length").alias("text_length"),
        F.collect_set(F.to_date("date_sent")).alias("days"))
    zero = F.lit(0.0)
    # A row per recipient and day for the bitmap of days; a recipient's first row carries the rest.
    rows = per_recipient.select("*", F.posexplode_outer("days").alias("i", "day"))
    once = F.coalesce(F.col("i"), F.lit(0)) == 0

    def per_head(c):
        return F.coalesce(F.sum(F.when(once, F.col(c))), zero).alias(c)

    per_kind = rows.groupBy(*group).agg(
        F.count_if(once & F.col("reached") & F.col("to").isNotNull()).alias("customers"),
        per_head("texts"), per_head("texts_sent"),
        # Counted with a missing recipient as one.
        F.count_if(once).alias("customers_targeted"),
        F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
        distinct_days(F.col("day")).alias("days"), per_head("price"),
        F.max("text_length").alias("text_length"))
    billed = F.when(F.col("is_mms"), F.col("mms_ratio") * F.col("texts")).when(
        ~F.col("is_mms"), F.col("texts"))
    per_kind = per_kind.join(org_config.select("org", "mms_ratio"), "org", "left")
    out = per_kind.groupBy("campaign_id", "org").agg(
        F.sum("customers").alias("customers"), F.sum("texts").alias("texts"),
        F.sum("texts_sent").alias("texts_sent"),
        F.sum("customers_targeted").alias("customers_targeted"),
        F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
        F.max("days").alias("days"), F.sum("price").alias("price"),
        F.max("text_length").alias("text_length"), F.bool_or("is_mms").alias("is_mms"),
        F.coalesce(F.sum(billed), zero).alias("billed_texts"))
    out = (out.withColumn("cost_per_customer", F.try_divide("price", "customers"))
           .withColumn("is_single_text", F.col("customers") < 3)
           .withColumn("is_many_days", F.col("days") > 2)
           .withColumn("pct_delivered", F.try_divide("texts", "texts_sent"))
           .withColumn("pct_reached", F.try_divide("customers", "customers_targeted")))
    return out if as_of is None else out.withColumn("updated_at", as_of)


def campaign_opt_outs(customer_sms: DataFrame) -> DataFrame:
    """Customers now unsubscribed, by the last campaign they received."""
    return (customer_sms.groupBy("org", F.col("last_campaign_id").alias("campaign_id"))
            .agg(F.count_if(~F.col("is_subscribed")).alias("unsubscribes")))


def with_opt_out_rate(delivery: DataFrame, opt_outs: DataFrame) -> DataFrame:
    return (delivery.join(opt_outs, ["campaign_id", "org"], "left")
            .withColumn("opt_out_rate", F.try_divide(F.col("unsubscribes").cast("double"),
                                                     F.col("customers").cast("double"))))


def campaign_roi(attributed: DataFrame, keys: list[str], *, customer: str = "customer_id"
                 ) -> DataFrame:
    """Sales, customers and win-backs per campaign in five horizons.

    Works on distinct (customer, order total, flags): two orders of a customer
    with equal totals and flags count once. Distinct customers come from a
    first roll-up per customer, so no row is multiplied for distinct counting.
    """
    flags = [f"is_{h}" for h in HORIZONS]
    orders = attributed.select(*keys, customer, "order_total", *flags, "was_lost").distinct()
    total, lost = F.col("order_total"), F.col("was_lost")
    per_customer = orders.groupBy(*keys, customer).agg(*[a for h in HORIZONS for a in (
        F.sum(F.when(F.col(f"is_{h}"), total)).alias(f"roi_{h}"),
        F.bool_or(F.col(f"is_{h}")).alias(f"in_{h}"),
        F.bool_or(F.col(f"is_{h}") & lost).alias(f"back_{h}"),
        F.sum(F.when(F.col(f"is_{h}") & lost, total)).alias(f"back_roi_{h}"))])
    named = F.col(customer).isNotNull()
    zero = F.lit(0.0)
    return per_customer.groupBy(*keys).agg(
        *[F.coalesce(F.sum(f"roi_{h}"), zero).alias(f"x{h}_roi") for h in HORIZONS],
        *[F.count_if(named & F.col(f"in_{h}")).alias(f"x{h}_customers") for h in HORIZONS],
        *[F.count_if(named & F.col(f"back_{h}")).alias(f"x{h}_recapture") for h in HORIZONS],
        *[F.coalesce(F.sum(f"back_roi_{h}"), zero).alias(f"x{h}_recapture_sales")
          for h in HORIZONS])


def product_roi(attributed: DataFrame, keys: list[str]) -> DataFrame:
    """Line sales and line counts per product within campaign, five horizons."""
    lines = attributed.distinct()
    return lines.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col(f"is_{h}"), F.col("order_line_total"))), F.lit(0.0))
          .alias(f"x{h}_roi") for h in HORIZONS],
        *[F.count_if(F.col(f"is_{h}")).alias(f"x{h}_orders") for h in HORIZONS])


def email_campaigns(campaign_info: DataFrame, delivery: DataFrame, roi: DataFrame) -> DataFrame:
    """Email campaigns with delivery rates and return; no statistics means 0."""
    out = campaign_info.join(delivery, "campaign_id", "left")
    for c in ("customers_reached", "delivery_rate", "open_rate", "click_rate"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    out = (out.withColumn("email_subject", clean_body(F.col("email_subject")))
           .withColumn("email_body", clean_body(F.col("email_body")))
           .withColumn("text_length", F.length("email_subject") + F.length("email_body")))
    return out.join(roi, "campaign_uuid", "left")


def sms_campaigns(delivery: DataFrame, opt_outs: DataFrame, campaign_info: DataFrame,
                  roi: DataFrame, *, hidden_orgs: tuple[str, ...] = ("demo",)) -> DataFrame:
    """Text campaigns: delivery, opt-out rate, campaign text and return per (campaign, org).

    Every delivered campaign stays; what is unknown about it is NULL. Campaigns
    of hidden organisations and of none are left out.
    """
    keys = ["campaign_id", "org"]
    out = with_opt_out_rate(delivery, opt_outs)
    out = out.join(campaign_info.withColumnRenamed("campaign_body", "body"), keys, "left")
    return (out.join(roi, keys, "left")
            .where(F.col("org").isNotNull() & ~F.col("org").isin(*hidden_orgs)))


# Carrier states that mean a text was not delivered.
_FAILED = ["delivery_failed", "sending_failed"]


def keep_send_exclusions(exclusions: DataFrame, send_log: DataFrame, carrier: DataFrame,
                         as_of: Column, *, retry_hours: int = 13, kept_hours: int = 24) -> DataFrame:
    """Recipients a campaign must not text again, without those that may be tried again.

    ``exclusions`` has (org, campaign_id, phone, timestamp). A recipient leaves
    it when a send of the last ``retry_hours`` was refused (a code other than
    200) or the carrier could not deliver it, or when the entry is older than
    ``kept_hours``. Entries without a time stay.
    """
    second = F.date_trunc("second", as_of)
    failed = (carrier.where((F.col("direction") == "outbound") & F.col("status").isin(_FAILED))
              .select(F.col("id").alias("msg_id")).distinct().withColumn("__failed", F.lit(True)))
    retried = (send_log.where(F.col("created_at_utc") >= second - F.expr(f"INTERVAL {retry_hours} HOURS"))
               .join(failed, "msg_id", "left")
               .where((F.col("http_code") != "200") | F.col("__failed"))
               .select("org", "campaign_id", F.col("to").alias("phone")).distinct())
    old = F.col("timestamp") < second - F.expr(f"INTERVAL {kept_hours} HOURS")
    return (exclusions.join(retried, ["org", "campaign_id", "phone"], "left_anti")
            .where(~F.coalesce(old, F.lit(False))))


def delivery_rates(campaigns: DataFrame, send_log: DataFrame, carriers: dict[str, DataFrame]
                   ) -> DataFrame:
    """Sends per campaign and status code as logged and as the carriers saw them.

    ``carriers`` maps service name -> its messages (msg_id, date_sent,
    error_code, optionally carrier); campaign ids come from the send log.
    """
    codes = ["http_code", "http_status_category", "http_status_message"]
    logged = send_log.groupBy("campaign_id", "org", *codes).agg(
        F.count(F.lit(1)).alias("send_logs_n"), F.min("created_at_utc").alias("start_log"),
        F.max("created_at_utc").alias("end_log"))
    seen = []
    for service, messages in carriers.items():
        if "carrier" not in messages.columns:
            messages = messages.withColumn("carrier", F.lit(None).cast("string"))
        ids = (send_log.where((F.col("sms_service") == service)
                              & F.col("campaign_id").isNotNull())
               .select("campaign_id", "msg_id").distinct())
        seen.append(messages.select("msg_id", "date_sent", "error_code", "carrier")
                    .join(ids, "msg_id").groupBy("campaign_id", "error_code", "carrier")
                    .agg(F.count(F.lit(1)).alias("sms_service_n"),
                         F.min("date_sent").alias("start_sent"),
                         F.max("date_sent").alias("end_sent"))
                    .withColumn("sms_service", F.lit(service)))
    return (campaigns.join(logged, ["campaign_id", "org"], "left")
            .join(stack(*seen), "campaign_id", "left"))
