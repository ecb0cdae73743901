"""Dimensions (D-1 .. D-10) and the shared current-record contexts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators.quality import require_columns
from .shared import memo, shared
from ..sources.adapters import Tables

TERMINATED = ("CANCELLED", "EXPIRED", "LAPSED")


# ---- type-1 views (projections) -------------------------------------------
def dim_account(t: Tables) -> DataFrame:
    return t.stg_accounts().select(
        "account_id", "customer_id", "product_id", "currency_code", "branch_id",
        "account_open_date", "account_close_date", "account_status", "opening_balance")


def dim_claim(t: Tables) -> DataFrame:
    return t.stg_claims().select(
        "claim_id", "claim_number", "loss_date", "reported_date", "claim_status",
        "cause_of_loss_code", "loss_location_code", "currency_code")


def dim_customer(t: Tables) -> DataFrame:
    return t.stg_customers().select(
        "customer_id", "customer_type", "first_name", "last_name", "organization_name",
        "segment", "country_code")


def dim_product(t: Tables) -> DataFrame:
    return t.stg_products().select(
        "product_code", "product_name", "product_line", "product_group", "coverage_type")


def dim_reserve_type(t: Tables) -> DataFrame:
    """Distinct reserve types with a key; ``is_active`` = 1 (the flag the
    relationships_where check filters on)."""
    base = t.stg_claim_reserves_snapshots().select("reserve_type").distinct()
    return base.select(surrogate_key("reserve_type").alias("reserve_type_sk"), "reserve_type",
                       F.lit(1).alias("is_active"))


# ---- type-2 dimensions ------------------------------------------------------
@shared("dim_policy")
def dim_policy(t: Tables) -> DataFrame:
    """Policy versions with attributes. Emits both status_start/end_date and
    effective_from/to (the tests and README use the latter)."""
    ps = t.policy_snapshot()
    pa = t.stg_policies()
    j = ps.join(pa, "policy_id", "left")
    status = F.col("policy_status")
    return j.select(
        surrogate_key("policy_id", "dbt_valid_from").alias("policy_sk"),
        "policy_id", "policy_number", "customer_id", "product_code", "policy_status",
        "policy_start_date", "policy_end_date", "premium_amount", "currency_code",
        F.col("dbt_valid_from").alias("status_start_date"),
        F.col("dbt_valid_to").alias("status_end_date"),
        F.col("dbt_valid_from").alias("effective_from"),
        F.col("dbt_valid_to").alias("effective_to"),
        F.col("dbt_valid_to").isNull().alias("is_current_record"),
        (status == "ACTIVE").alias("is_active_policy"),
        F.coalesce(status.isin(*TERMINATED), F.lit(False)).alias("is_terminated_policy"),
    )


@memo
def account_summary(t: Tables) -> DataFrame:
    a = t.stg_accounts()
    return a.groupBy("customer_id").agg(
        F.countDistinct("account_id").alias("total_accounts"),
        F.sum(F.when(F.col("account_status") == "ACTIVE", 1).otherwise(0)).alias("active_accounts"),
        F.min("account_open_date").alias("first_account_open_date"),
        F.max("account_open_date").alias("latest_account_open_date"))


@shared("dim_customer_360")
def dim_customer_360(t: Tables) -> DataFrame:
    cs = t.customer_snapshot()
    j = cs.join(account_summary(t), "customer_id", "left")
    return j.select(
        surrogate_key("customer_id", "dbt_valid_from").alias("customer_sk"),
        "customer_id", "first_name", "last_name", "date_of_birth", "customer_type",
        "kyc_status", "risk_rating", "country_code",
        F.coalesce("total_accounts", F.lit(0)).cast("bigint").alias("total_accounts"),
        F.coalesce("active_accounts", F.lit(0)).cast("bigint").alias("active_accounts"),
        "first_account_open_date", "latest_account_open_date",
        F.col("dbt_valid_from").alias("customer_start_date"),
        F.col("dbt_valid_to").alias("customer_end_date"),
        F.col("dbt_valid_to").isNull().alias("is_current_record"),
    )


@shared("dim_account_lifecycle")
def dim_account_lifecycle(t: Tables) -> DataFrame:
    s = t.account_snapshot()
    a = t.stg_accounts().select("account_id", "account_open_date", "account_close_date",
                                "branch_code", "currency_code")
    j = s.join(a, "account_id", "left")
    st = F.col("account_status")
    return j.select(
        surrogate_key("account_id", "dbt_valid_from").alias("account_lifecycle_sk"),
        "account_id", "customer_id", "account_status", "product_code", "branch_code",
        "currency_code", "account_open_date", "account_close_date",
        F.col("dbt_valid_from").alias("status_start_date"),
        F.col("dbt_valid_to").alias("status_end_date"),
        F.col("dbt_valid_to").isNull().alias("is_current_status"),
        (st == "OPEN").alias("is_opened"), (st == "ACTIVE").alias("is_active"),
        (st == "DORMANT").alias("is_dormant"), (st == "CLOSED").alias("is_closed"),
    )


# ---- current-record contexts (dimension-sized; joined to facts once) -------
@memo
def current_customer(t: Tables) -> DataFrame:
    """Current record of dim_customer_360 (risk rating, country). Read from the
    materialised dimension when the pipeline has built it; otherwise taken
    straight from the change log's last entry per customer, which avoids
    building the whole version chain."""
    if "dim_customer_360" in getattr(t, "materialized", {}):
        cur = dim_customer_360(t).where("is_current_record")
    else:
        cur = t.customer_current()
    return cur.select("customer_id", "risk_rating", F.col("country_code").alias("customer_country"))


@memo
def current_account(t: Tables) -> DataFrame:
    return (dim_account_lifecycle(t).where("is_current_status")
            .select("account_id", "customer_id", "product_code"))


@shared("current_policy")
def current_policy(t: Tables) -> DataFrame:
    return (dim_policy(t).where("is_current_record")
            .select("policy_id", "policy_sk", "customer_id", "product_code"))


@memo
def account_context(t: Tables) -> DataFrame:
    """Current account joined to its current customer: built on the dimension
    side so a fact joins it once, on account_id."""
    return current_account(t).join(current_customer(t), "customer_id", "left")


@memo
def policy_context(t: Tables) -> DataFrame:
    return current_policy(t).join(current_customer(t).select("customer_id", "risk_rating"),
                                  "customer_id", "left")


# ---- orders mart ------------------------------------------------------------
def _with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with the sum of successful payments (0 when none)."""
    pay = (payments.groupBy("order_id")
           .agg(F.sum(F.when(F.col("status") == "success", F.col("amount"))).cast("decimal(38,2)")
                .alias("amount")))
    out = (orders.join(pay, "order_id", "left")
           .select("order_id", "customer_id", "order_date",
                   F.coalesce(F.col("amount"), F.lit(0).cast("decimal(38,2)")).alias("amount")))
    require_columns(out, ["order_id", "customer_id", "order_date", "amount"], "fct_orders")
    return out


@shared("fct_orders")
def fct_orders(t: Tables) -> DataFrame:
    return _with_payments(t.stg_orders(), t.stg_payments())


def fct_orders_changes(t: Tables, stored: DataFrame, since: dt.datetime) -> DataFrame:
    """Orders updated at or after ``since`` (an order's update time follows its payments), whole."""
    changed = t.stg_orders().where(F.col("updated_at") >= F.lit(str(since)).cast("timestamp_ntz"))
    return _with_payments(changed, t.stg_payments().join(changed.select("order_id"), "order_id", "left_semi"))


def _customers_with_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    co = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("order_id").alias("number_of_orders"),
        F.sum("amount").cast("decimal(38,2)").alias("lifetime_value"))
    return (customers.join(co, "customer_id", "left")
            .select("customer_id", "first_name", "last_name", "first_order_date",
                    "most_recent_order_date",
                    F.coalesce("number_of_orders", F.lit(0)).alias("number_of_orders"),
                    "lifetime_value"))


def dim_customers(t: Tables) -> DataFrame:
    return _customers_with_orders(t.stg_customers(), fct_orders(t))


def dim_customers_changes(t: Tables, stored: DataFrame, since: dt.datetime) -> DataFrame:
    """Customers that are new, have other attributes, or have an order updated at or after ``since``,
    each from all its orders."""
    names = ["customer_id", "first_name", "last_name"]
    differ = t.stg_customers().select(*names).subtract(stored.select(*names)).select("customer_id")
    ordered = t.stg_orders().where(F.col("updated_at") >= F.lit(str(since)).cast("timestamp_ntz")).select("customer_id")
    touched = differ.unionByName(ordered).distinct()
    return _customers_with_orders(t.stg_customers().join(touched, "customer_id", "left_semi"),
                                  fct_orders(t).join(touched, "customer_id", "left_semi"))
