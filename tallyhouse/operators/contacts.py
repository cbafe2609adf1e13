"""Phones, opt-in status, message history and carriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.orders import order_key
from ..functions.text import alnum_words, clean_body, opt_in_flag, opt_out_flag
from ..session import Stage, lazily
from .joins import first_row_per_key, flag_listed
from .ordered import Bucket, fill_ordered, keep_at_max, latest_row
from .reshape import stack

# Channels of an opt-in status, strongest first. Tables that already hold other
# labels for the five channels are continued by passing those labels.
CHANNELS = ["sms_response", "custom_code", "webhook", "file_import", "pos"]


def optin_status(sms_response: DataFrame, custom_code: DataFrame, webhook: DataFrame,
                 file_import: DataFrame, pos: DataFrame, active_orgs: DataFrame, *,
                 latest_only: bool = False, channels: list[str] = CHANNELS,
                 stage: Stage = lazily) -> DataFrame:
    """Opt-in status per organisation and phone from its strongest channel.

    All channels are stacked with their rank and the best rank per (org, phone)
    is kept: one aggregation instead of a chain of anti joins. Several rows of
    that channel stay unless ``latest_only``. The stacked channels are read
    twice; ``stage`` keeps their inputs from being read twice as well.
    """
    def choice(cond):
        return F.when(cond, "opt_in").otherwise("opt_out")

    replied = (sms_response.where(F.col("orguuid").isNotNull() & F.col("phone").isNotNull()
                                  & (F.col("unsubscribed_at_utc").isNotNull()
                                     | F.col("resubscribed_at_utc").isNotNull()))
               .select("orguuid", "phone",
                       F.when(F.col("is_subscribed"), F.col("resubscribed_at_utc"))
                       .otherwise(F.col("unsubscribed_at_utc")).alias("ts"),
                       choice(F.col("is_subscribed")).alias("status")))
    custom = custom_code.where(F.col("phone").isNotNull()).select("orguuid", "phone", "ts",
                                                                  "status")
    hook = webhook.select("orguuid", "phone", F.col("ts_gmt").alias("ts"),
                          F.lit("opt_in").alias("status"))
    imported = file_import.select("orguuid", "phone", F.col("time").alias("ts"),
                                  choice(F.col("opted_in")).alias("status"))
    register = latest_row(pos.where(F.col("phone").isNotNull()).select(
        "orguuid", "phone", F.coalesce("last_updated_utc", F.timestamp_seconds(F.lit(0)))
        .alias("ts"), choice(F.coalesce("pos_is_subscribed", F.lit(False))).alias("status")),
        ["orguuid", "phone"], ["ts"])
    ranked = stack(*[df.withColumn("channel", F.lit(name)).withColumn("__rank", F.lit(rank))
                     for rank, (name, df) in enumerate(zip(
                         channels, (replied, custom, hook, imported, register)))])
    active = active_orgs.select("orguuid").distinct()
    ranked = stage(ranked.join(active, "orguuid", "left_semi").distinct())
    best = keep_at_max(ranked, ["orguuid", "phone"], "__rank", smallest=True).drop("__rank")
    if latest_only:
        return latest_row(best, ["orguuid", "phone"], ["ts"])
    return best


def customer_sms(messages: DataFrame, *, whole_word: bool = False) -> DataFrame:
    """Where each customer stands after their whole message history.

    The state after the last message is the newest value of each kind, so one
    aggregation per customer replaces the ordered fill.
    """
    outbound = F.coalesce("sent_from_messaging_service", F.lit(False))
    inbound = ~F.coalesce("sent_from_messaging_service", F.lit(True)) & F.col("body").isNotNull()
    rows = (messages.withColumn("body", clean_body(F.col("body")))
            .withColumn("phone", F.when(F.col("sent_from_messaging_service"), F.col("to"))
                        .when(~F.col("sent_from_messaging_service"), F.col("from"))))
    at = F.struct("date_sent", "msg_id")

    def newest(value: Column, when: Column) -> Column:
        return F.max_by(value, F.when(when & value.isNotNull(), at))

    stop = F.max(F.when(inbound & opt_out_flag(F.col("body"), whole_word), F.col("date_sent")))
    start = F.max(F.when(inbound & opt_in_flag(F.col("body"), whole_word), F.col("date_sent")))
    epoch = F.timestamp_seconds(F.lit(0))
    return rows.groupBy("phone", "org_uuid").agg(
        (~(F.coalesce(stop, epoch) > F.coalesce(start, epoch))).alias("is_subscribed"),
        stop.alias("unsubscribed_at_utc"), start.alias("resubscribed_at_utc"),
        F.max(F.when(outbound, F.col("date_sent"))).alias("last_sms_engagement_utc"),
        newest(F.col("body"), outbound).alias("last_msg_received"),
        newest(alnum_words(F.col("body")), inbound).alias("last_customer_resp"),
        newest(F.col("campaign_id"), outbound).alias("last_campaign_id"),
        F.count_if(outbound).alias("tot_sms_received"))


def next_message_flag(messages: DataFrame, keys: list[str], order_by: list[str], flag: str,
                      name: str, *, bucket: Bucket | None = "month") -> DataFrame:
    """The flag of the customer's next message; FALSE after the last one."""
    known = messages.withColumn("__flag", F.coalesce(F.col(flag), F.lit(False)))
    out = fill_ordered(known, keys, order_by, {name: "__flag"}, direction="up",
                       include_current=False, bucket=bucket)
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False))).drop("__flag")


def integrated_customers(customers: DataFrame, opt_outs: DataFrame, zip_city: DataFrame,
                         pos_opt_out_orgs: list[str]) -> DataFrame:
    """Customers with subscription state, message count and city by zip code.

    Organisations whose register has no opt-ins count as not subscribed there.
    Blank text becomes NULL.
    """
    out = (customers
           .withColumn("pos_is_subscribed", F.when(F.col("org").isin(pos_opt_out_orgs),
                                                   F.lit(False))
                       .otherwise(F.col("pos_is_subscribed")))
           .join(opt_outs, ["phone", "org"], "left")
           .withColumn("is_subscribed", F.coalesce("is_subscribed", "pos_is_subscribed",
                                                   F.lit(True)))
           .withColumn("tot_sms_received", F.coalesce("tot_sms_received", F.lit(0))))
    text = [name for name, kind in out.dtypes if kind == "string"]
    out = out.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in text else F.col(c)
                       for c in out.columns])
    return (out.join(zip_city.select("zipcode", "zipcity"), "zipcode", "left")
            .withColumn("city", F.upper(F.coalesce("zipcity", "city"))).drop("zipcity"))


def person_ids(customers: DataFrame, known: DataFrame, *, org: str = "org_uuid") -> DataFrame:
    """A stable person id for new phones: one row per (org, phone, register id).

    The grain is the same for a placeholder phone that a large part of all
    customers share and for any other, so joins on (org, phone, customer_id)
    never repeat rows.
    """
    new = (customers.where(F.col("phone").isNotNull())
           .join(known.select(org, "phone").distinct(), [org, "phone"], "left_anti")
           .select(org, "phone", F.col("customer_id").cast("string").alias("customer_id"))
           .distinct())
    return new.withColumn("person_id", order_key(F.col(org), F.col("phone")))


def joined_person_ids(ids: DataFrame, *, org: str = "org_uuid", part: int = 10_000) -> DataFrame:
    """One row per phone: its register ids as one text, joined by ``|``.

    A phone with more than ``part`` ids is first gathered in parts of about that
    many; only these meet in one row. The text still holds all ids of a phone;
    where it may grow too long for a row, use the rows of ``person_ids``.
    """
    keys = [org, "phone", "person_id"]
    large = (ids.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > part)
             .withColumn("__parts", F.ceil(F.col("__n") / part)).drop("__n"))
    dealt = ids.join(large, keys, "left").withColumn("__part", F.coalesce(
        F.pmod(F.xxhash64("customer_id"), F.col("__parts")), F.lit(0)))
    parts = dealt.groupBy(*keys, "__part").agg(F.collect_list("customer_id").alias("__ids"))
    return parts.groupBy(*keys).agg(F.concat_ws("|", F.sort_array(
        F.flatten(F.collect_list("__ids")))).alias("pos_customer_id"))


def phones_info(customer_sms: DataFrame, optins: DataFrame, carriers: DataFrame,
                blocked: DataFrame) -> DataFrame:
    """Phone list of an organisation with message history, opt-in and carrier."""
    newest = latest_row(carriers, ["phone"], ["updated_at_utc"]).select(
        "phone", "carrier", "normalized_carrier")
    status = optins.select("org", "phone", F.when(F.col("status") == "opt_in", "Y")
                           .otherwise("N").alias("opt_in"))
    joined = (customer_sms.join(status, ["org", "phone"], "full")
              .join(newest, "phone", "left"))
    flagged = flag_listed(joined, blocked, "carrier", "blocked_by_carrier")
    rows = flagged.select(
        "org", F.col("phone").alias("last_customer_phone"),
        F.col("last_sms_engagement_utc").alias("last_sms"),
        F.col("tot_sms_received").alias("tot_sms"),
        F.col("last_campaign_id").alias("latest_campaign_id"),
        F.col("tot_sms_received").alias("latest_tot_sms"), "opt_in", "carrier",
        "normalized_carrier", "blocked_by_carrier")
    return first_row_per_key(rows, ["org", "last_customer_phone"], [
        F.col("last_sms").desc_nulls_last(), F.col("opt_in").desc_nulls_last(),
        F.col("latest_campaign_id").desc_nulls_last()])


def phone_carriers(sent: list[DataFrame], stored: DataFrame, as_of: Column, *,
                   keep_days: int = 30) -> DataFrame:
    """Newest carrier per phone from yesterday's sends and stored values that are fresh.

    Each frame has (phone, carrier, updated_at_utc).
    """
    named = F.col("carrier").isNotNull() & (F.length("carrier") > 0)
    fresh = [df.where(named).select("phone", "carrier", "updated_at_utc") for df in sent]
    todays = keep_at_max(stack(*fresh).distinct(), ["phone"], "updated_at_utc")
    oldest = F.date_sub(F.to_date(as_of), keep_days).cast("timestamp")
    kept = stored.where(F.col("updated_at_utc") >= oldest)
    return latest_row(stack(todays, kept.select("phone", "carrier", "updated_at_utc")),
                      ["phone"], ["updated_at_utc"])


def phones_to_look_up(stored: DataFrame, current: DataFrame, contacted: DataFrame, as_of: Column,
                      *, keep_days: int = 30) -> DataFrame:
    """Phones whose stored carrier is too old and that nothing newer covers."""
    oldest = F.date_sub(F.to_date(as_of), keep_days).cast("timestamp")
    old = stored.where(F.col("updated_at_utc") < oldest).select("phone")
    return old.subtract(contacted.select("phone")).subtract(current.select("phone"))


# Behaviour columns the list shows as 0 when a customer has none.
CRM_ZERO_COLUMNS = ["total_purchases_usd", "avg_time_between_orders", "avg_order_size",
                    "pct_delivery", "avg_order_time"]


def latest_carts(carts: DataFrame, as_of: Column) -> DataFrame:
    """Days since the newest abandoned cart, one row per phone and organisation."""
    dated = carts.where(F.col("phone").isNotNull()).withColumn("__day", F.to_date("created_at"))
    return keep_at_max(dated, ["phone"], "__day").select(
        "phone", F.datediff(F.to_date(as_of), "__day").alias("days_since_cart"),
        "orguuid").distinct()


def crm_table(customers: DataFrame, optins: DataFrame, carts: DataFrame, behavior: DataFrame,
              as_of: Column, zero_columns: list[str] = CRM_ZERO_COLUMNS) -> DataFrame:
    """Marketing list: customers with opt-in, cart and behaviour, gaps filled.

    Opt-in is the channel status if known, else the register's flag, else no.
    """
    opted = (F.when(F.col("status") == "opt_in", "Y").when(F.col("status") == "opt_out", "N")
             .when(F.col("pos_is_subscribed"), "Y").otherwise("N"))
    base = (customers.where(F.col("customer_id").isNotNull()
                            & F.col("last_updated_utc").isNotNull())
            .join(optins.select("phone", "orguuid", "status"), ["phone", "orguuid"], "left")
            .join(latest_carts(carts, as_of), ["phone", "orguuid"], "left")
            .withColumn("last_opted_in", opted)
            .withColumnRenamed("phone", "last_customer_phone")
            .withColumnRenamed("last_updated_utc", "updated_at")
            .drop("status", "pos_is_subscribed"))
    out = (base.join(behavior, ["customer_id", "org"], "left")
           .withColumn("last_order_facility", F.coalesce("last_order_facility",
                                                         F.lit("Never Ordered")))
           .withColumn("last_order_source", F.coalesce("last_order_source", F.lit("Unknown")))
           .withColumn("last_order_date", F.coalesce("last_order_date", "updated_at"))
           .withColumn("first_order_date", F.coalesce("first_order_date", "updated_at"))
           .withColumn("num_orders", F.coalesce("num_orders", F.lit(0))))
    shares = [c for c in out.columns if c.startswith("pct_")]
    for c in dict.fromkeys([*zero_columns, *shares]):
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return out.distinct()
