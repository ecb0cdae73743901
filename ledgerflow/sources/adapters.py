"""Staging adapters: the driver's TPC-H-style tables mapped onto the staging
contracts the jobs read (stg_accounts, policy_snapshot, ...).

Each adapter is a lazy DataFrame over one Parquet scan (plus small lookups),
so Catalyst prunes columns and pushes filters into the scan of every job
that uses it. Nothing is cached or collected here.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import MONEY, parts_total, sum_parts
from ..session import size_shuffles

# Fixed values taken from the staging contracts.
PERSON_SEGMENTS = ("HOUSEHOLD", "FURNITURE")
INSOLVENCY_CODES = ("BANKRUPT", "IVA", "DRO", "ADMINISTRATION", "LIQUIDATION")
AML_THRESHOLDS = (("LARGE_TRANSACTION", 400000), ("HIGH_VELOCITY_TXN", 2))
BANK_HOLIDAYS = ("2001-01-01", "2001-04-13", "2001-05-07", "2001-05-28", "2024-01-01")

# Fixed run dates: order-derived jobs and event-derived jobs.
ORDERS_AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


# Adapters with a form of the same rows and columns that skips the lookups.
LEAN_FORMS = {"stg_transactions": ("stg_transactions_lean",)}


def _d(s: str) -> Column:
    return F.lit(s).cast("date")


def line_id() -> Column:
    """Line identifier: (l_orderkey, l_linenumber) alone is not unique."""
    return F.concat_ws("-", *[F.col(c).cast("string") for c in
                              ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def _status_by_mod4(key: Column) -> Column:
    m = key % 4
    return (F.when(m == 0, "OPEN").when(m == 1, "ACTIVE").when(m == 2, "DORMANT")
            .otherwise("CLOSED"))


def _memo_adapter(fn):
    """One DataFrame per adapter and Tables handle (same subtree in every use)."""
    name = fn.__name__

    @functools.wraps(fn)
    def wrapper(self):
        c = self.__dict__.setdefault("_adapters", {})
        if name not in c:
            c[name] = fn(self)
        return c[name]
    return wrapper


class Tables:
    """Reader for one scale-factor directory and the contracts derived from it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._bytes: dict[str, int] = {}
        self.materialized: dict[str, DataFrame] = {}
        self._preds: dict[str, Column] = {}

    def restrict(self, **predicates) -> "Tables":
        """A view of the same tables where the named adapters are filtered, e.g.
        ``t.restrict(stg_transactions=F.col("transaction_timestamp") < cutoff)``.
        Used to replay incremental runs against the same inputs."""
        new = Tables(self.spark, self.sf_dir)
        new._raw, new._bytes = self._raw, self._bytes
        # models stored by the full run hold the rows this view leaves out: start without them
        preds = dict(self._preds)
        for name, pred in predicates.items():
            for n in (name, *LEAN_FORMS.get(name, ())):
                preds[n] = preds[n] & pred if n in preds else pred
        for name, pred in preds.items():
            base = getattr(type(self), name)
            setattr(new, name, (lambda b=base, p=pred: b(new).where(p)))
        new._preds = preds
        return new

    # ---- raw tables -------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._raw[name] = table
            # from the file listing that the reader has made: no file is read
            self._bytes[name] = int(str(table._jdf.queryExecution().analyzed().stats().sizeInBytes()))
            size_shuffles(self.spark, sum(self._bytes.values()))
        return self._raw[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.raw(name)
        raise AttributeError(name)

    def _customer_nation(self) -> DataFrame:
        return self.raw("customer").join(
            self.raw("nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"))

    @staticmethod
    def _is_person(seg: Column) -> Column:
        return seg.isin(*PERSON_SEGMENTS)

    # ---- customers and accounts -------------------------------------------
    def stg_customers(self) -> DataFrame:
        c = self._customer_nation()
        person = self._is_person(F.col("c_mktsegment"))
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.when(person, "PERSON").otherwise("ORGANIZATION").alias("customer_type"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.when(person, F.lit(None).cast("string")).otherwise(F.col("c_name"))
            .alias("organization_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country_code"),
        )

    def stg_accounts(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("account_id"),
            F.expr("c_custkey div 2").alias("customer_id"),
            F.col("c_nationkey").alias("product_id"),
            F.when(F.col("c_nationkey") % 2 == 0, "GBP").otherwise("EUR").alias("currency_code"),
            F.col("c_nationkey").alias("branch_id"),
            F.concat(F.lit("B"), F.col("c_nationkey").cast("string")).alias("branch_code"),
            F.date_add(_d("2001-01-01"), (k % 60).cast("int")).alias("account_open_date"),
            F.when(k % 4 == 3, _d("2001-07-01")).alias("account_close_date"),
            _status_by_mod4(k).alias("account_status"),
            F.col("c_acctbal").cast(MONEY).alias("opening_balance"),
        )

    def account_snapshot(self) -> DataFrame:
        """Account history: every account has a version from 2001-01-01; one in
        three is reopened with a second version from 2001-04-01."""
        c = self.raw("customer")
        k = F.col("c_custkey")
        two = (k % 3 == 0)
        versions = c.withColumn("n", F.explode(F.when(two, F.array(F.lit(0), F.lit(1)))
                                               .otherwise(F.array(F.lit(0)))))
        n = F.col("n")
        return versions.select(
            k.alias("account_id"),
            F.expr("c_custkey div 2").alias("customer_id"),
            F.when((n == 0) & two, "OPEN").otherwise(_status_by_mod4(k)).alias("account_status"),
            F.col("c_mktsegment").alias("product_code"),
            F.when(F.col("c_acctbal") < 0, "HIGH").otherwise("LOW").alias("account_risk_rating"),
            F.when(n == 0, _d("2001-01-01")).otherwise(_d("2001-04-01")).alias("dbt_valid_from"),
            F.when((n == 0) & two, _d("2001-04-01")).alias("dbt_valid_to"),
        )

    def customer_snapshot(self) -> DataFrame:
        """Customer history with orders as the change log; last order of a day wins.

        The change log is first reduced to one row per (customer, day) with a
        grouped max_by (partial aggregation, so a customer with a third of all
        orders is combined map-side); the version chain then orders at most
        one row per customer-day.
        """
        o = self.raw("orders")
        daily = (o.groupBy(F.col("o_custkey"), F.col("o_orderdate"))
                 .agg(F.max_by(F.struct("o_orderstatus", "o_orderpriority"), F.col("o_orderkey"))
                      .alias("last")))
        from ..operators.scd2 import close_versions
        hist = close_versions(
            daily.select("o_custkey", F.col("o_orderdate").cast("date").alias("d"),
                         "last.o_orderstatus", "last.o_orderpriority"),
            keys=["o_custkey"], valid_from="d", valid_to="nd")
        c = self._customer_nation().select("c_custkey", "c_name", "c_mktsegment", "n_name")
        j = hist.join(c, F.col("o_custkey") == F.col("c_custkey"))
        s = F.col("o_orderstatus")
        return j.select(
            F.col("o_custkey").alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.date_add(_d("1960-01-01"), (F.col("c_custkey") % 9000).cast("int")).alias("date_of_birth"),
            F.when(self._is_person(F.col("c_mktsegment")), "PERSON").otherwise("ORGANIZATION")
            .alias("customer_type"),
            F.when(s == "F", "FAILED").when(s == "O", "PENDING").otherwise("PASSED").alias("kyc_status"),
            F.col("o_orderpriority").alias("risk_rating"),
            F.col("n_name").alias("country_code"),
            F.col("d").alias("dbt_valid_from"),
            F.col("nd").alias("dbt_valid_to"),
        )

    def customer_current(self) -> DataFrame:
        """The open version of ``customer_snapshot`` for each customer, in one
        grouped aggregate: the last order of the customer's latest order day
        (highest order key). Same attribute mapping as the history."""
        o = self.raw("orders")
        last = (o.groupBy("o_custkey")
                .agg(F.max_by(F.struct("o_orderstatus", "o_orderpriority"),
                              F.struct("o_orderdate", "o_orderkey")).alias("last")))
        c = self._customer_nation().select("c_custkey", "n_name")
        return last.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_custkey").alias("customer_id"),
            F.col("last.o_orderpriority").alias("risk_rating"),
            F.col("n_name").alias("country_code"))

    # ---- policies and products --------------------------------------------
    def stg_policies(self) -> DataFrame:
        o = self.raw("orders")
        d = F.col("o_orderdate").cast("date")
        return o.select(
            F.col("o_orderkey").alias("policy_id"),
            F.concat(F.lit("POL-"), F.col("o_orderkey").cast("string")).alias("policy_number"),
            F.col("o_orderpriority").alias("product_code"),
            d.alias("policy_start_date"),
            F.date_add(d, 365).alias("policy_end_date"),
            F.col("o_totalprice").cast(MONEY).alias("premium_amount"),
            F.lit("GBP").alias("currency_code"),
        )

    def policy_snapshot(self) -> DataFrame:
        """Policy history: every policy starts ACTIVE; non-pending ones end after
        90 days and get a CANCELLED or EXPIRED version."""
        o = self.raw("orders")
        two = F.col("o_orderstatus") != "P"
        v = o.withColumn("n", F.explode(F.when(two, F.array(F.lit(0), F.lit(1)))
                                        .otherwise(F.array(F.lit(0)))))
        n = F.col("n")
        d = F.col("o_orderdate").cast("date")
        return v.select(
            F.col("o_orderkey").alias("policy_id"),
            F.col("o_custkey").alias("customer_id"),
            F.when(n == 0, "ACTIVE").when(F.col("o_orderstatus") == "F", "CANCELLED")
            .otherwise("EXPIRED").alias("policy_status"),
            F.when(F.col("o_totalprice") > 250000, "HIGH").otherwise("LOW").alias("policy_risk_rating"),
            F.date_add(d, 90 * n).alias("dbt_valid_from"),
            F.when((n == 0) & two, F.date_add(d, 90)).alias("dbt_valid_to"),
        )

    def stg_products(self) -> DataFrame:
        p = self.raw("orders").select("o_orderpriority").distinct()
        return p.select(
            F.col("o_orderpriority").alias("product_code"),
            F.concat(F.lit("Product "), F.col("o_orderpriority")).alias("product_name"),
            F.lit("GENERAL").alias("product_line"),
            F.lit("RETAIL").alias("product_group"),
            F.lit("STANDARD").alias("coverage_type"),
        )

    # ---- premiums, claims, reserves ----------------------------------------
    def stg_premium_transactions(self) -> DataFrame:
        li = self.raw("lineitem")
        rf = F.col("l_returnflag")
        return li.select(
            line_id().alias("premium_txn_id"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_shipdate").alias("posting_date"),
            F.when(rf == "R", "refund").when(rf == "A", "earned").otherwise("written").alias("premium_type"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.lit("GBP").alias("currency_code"),
        )

    def stg_claims(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        ln = F.col("l_linenumber") % 3
        return li.select(
            line_id().alias("claim_id"),
            F.concat(F.lit("C-"), F.col("l_orderkey").cast("string")).alias("claim_number"),
            F.col("l_orderkey").alias("policy_id"),
            F.col("l_shipdate").alias("claim_reported_date"),
            F.col("l_shipdate").cast("date").alias("reported_date"),
            F.date_sub(F.col("l_shipdate").cast("date"), 10).alias("loss_date"),
            F.when(F.col("l_linestatus") == "F", "PROPERTY").otherwise("MOTOR").alias("claim_type"),
            F.when(ln == 0, "OPEN").when(ln == 1, "CLOSED").otherwise("REOPENED").alias("claim_status"),
            F.col("l_linenumber").cast("string").alias("cause_of_loss_code"),
            F.col("l_suppkey").cast("string").alias("loss_location_code"),
            F.lit("GBP").alias("currency_code"),
        )

    def stg_claim_payments(self) -> DataFrame:
        li = self.raw("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
        v = li.select(line_id().alias("claim_id"), "l_extendedprice").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
        return v.select(
            "claim_id",
            F.col("n").alias("payment_no"),
            (F.col("l_extendedprice").cast(MONEY) * F.col("n")).alias("payment_amount"),
        )

    def stg_claim_reserves(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        v = li.select(line_id().alias("claim_id"), "l_quantity").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        return v.select(
            "claim_id",
            F.col("n").alias("reserve_no"),
            (F.col("l_quantity") * 100 * F.col("n")).cast(MONEY).alias("reserve_amount"),
        )

    def stg_claim_reserves_snapshots(self) -> DataFrame:
        li = self.raw("lineitem").where(F.col("l_returnflag") == "R")
        v = (li.select(line_id().alias("claim_id"), F.col("l_shipdate").cast("date").alias("d"), "l_quantity")
             .withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
             .withColumn("rt", F.explode(F.array(F.lit("CASE"), F.lit("EXPENSE")))))
        mult = F.when(F.col("rt") == "CASE", 10).otherwise(1)
        return v.select(
            "claim_id",
            F.date_add("d", 20 * F.col("n")).alias("reserve_snapshot_date"),
            F.col("rt").alias("reserve_type"),
            (F.col("l_quantity") * (10 + F.col("n")) * mult).cast(MONEY).alias("reserve_amount"),
        )

    def stg_ifrs_contract_metrics(self) -> DataFrame:
        li = self.raw("lineitem")
        g = (li.groupBy(F.col("l_orderkey"),
                        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m"))
             .agg(*sum_parts(F.col("l_extendedprice").cast(MONEY), "s")))
        g = g.withColumn("s", parts_total("s").cast("decimal(28,2)"))
        return g.select(
            F.col("l_orderkey").alias("policy_id"),
            F.col("m").alias("reporting_period"),
            (F.col("s") * F.lit(0.1).cast("decimal(1,1)")).cast(MONEY).alias("csm"),
            (F.col("s") * F.lit(0.02).cast("decimal(2,2)")).cast(MONEY).alias("risk_adjustment"),
        )

    # ---- banking transactions, limits, exposures ----------------------------
    def stg_transactions_lean(self) -> DataFrame:
        """Transactions without the country: one scan of orders, no join."""
        o = self.raw("orders")  # every order; those before an account opened never enter a balance
        return o.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_orderdate").alias("transaction_timestamp"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
            F.lit("GBP").alias("currency_code"),
            F.when(F.col("o_orderstatus") == "F", "debit").otherwise("credit").alias("transaction_type"),
            F.col("o_orderpriority").alias("merchant_name"),
        )

    def stg_transactions(self) -> DataFrame:
        country = self._customer_nation().select(F.col("c_custkey").alias("account_id"), F.col("n_name").alias("country_code"))
        return self.stg_transactions_lean().join(country, "account_id").select(
            "transaction_id", "account_id", "transaction_timestamp", "amount", "currency_code",
            "transaction_type", "merchant_name", "country_code")

    def stg_credit_limits(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        return c.select(
            k.alias("account_id"),
            F.when(k % 7 == 0, F.lit(0)).otherwise(5000 + k % 1000).cast(MONEY).alias("credit_limit"),
            F.when(k % 5 == 0, _d("2001-06-01")).alias("limit_end_date"),
        )

    def exposures(self) -> DataFrame:
        o = self.raw("orders")
        s = F.col("o_orderstatus")
        return o.select(
            F.col("o_orderkey").alias("exposure_id"),
            F.col("o_custkey").alias("account_id"),
            (F.col("o_custkey") % 50).alias("counterparty_id"),
            F.col("o_totalprice").cast(MONEY).alias("exposure_amount"),
            F.lit("GBP").alias("exposure_currency"),
            F.when(s == "F", "CREDIT").when(s == "O", "MARKET").otherwise("OPERATIONAL").alias("risk_type"),
            F.col("o_orderpriority").alias("asset_class"),
            F.col("o_orderdate").cast("date").alias("exposure_date"),
        )

    # ---- risk scores and insolvency events ----------------------------------
    def stg_risk_scores(self) -> DataFrame:
        e = self.raw("events")
        t = F.col("event_type")
        return e.select(
            F.col("event_id").alias("score_id"),
            F.col("user_id").alias("entity_id"),
            F.when(t == "click", "CUSTOMER").when(t == "view", "ACCOUNT").otherwise("POLICY").alias("entity_type"),
            F.col("value").alias("risk_score"),
            F.when(F.col("value") > 50, "high").otherwise("low").alias("risk_category"),
            F.col("ts").alias("score_date"),
        )

    def insolvency_events(self) -> DataFrame:
        e = self.raw("events")  # every event; types without a code of the list become OTHER
        t = F.col("event_type")
        return e.select(
            F.col("user_id").alias("account_id"),
            F.expr("user_id div 2").alias("customer_id"),
            F.when(t == "error", "BANKRUPT").when(t == "view", "IVA").otherwise("OTHER").alias("insolvency_code"),
            F.col("ts").alias("event_date"),
            F.when(F.col("value") > 50, "open").otherwise("closed").alias("event_status"),
        )

    # ---- retail, orders, payments -----------------------------------------
    def retail_daily_transactions(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        c = self._customer_nation().select("c_custkey", "n_name")
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
        rf = F.col("l_returnflag")
        loyal = F.col("l_linestatus") == "F"
        return j.select(
            line_id().alias("transaction_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
            F.col("n_name").alias("store_area"),
            F.concat(F.lit("BANK"), (F.col("l_suppkey") % 5).cast("string")).alias("payment_bank"),
            F.when(rf == "R", "DEBIT").when(rf == "A", "CREDIT").otherwise("PREPAID").alias("payment_card_type"),
            F.col("l_extendedprice").cast(MONEY).alias("transaction_amount"),
            F.col("l_shipdate").alias("transaction_timestamp"),
            loyal.alias("loyalty_member_flag"),
            F.when(loyal, F.floor(F.col("l_quantity"))).otherwise(F.lit(0)).cast("bigint").alias("loyalty_points_earned"),
            F.col("l_shipdate").alias("last_updated_at"),
        )

    def stg_orders(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            F.when(F.col("o_orderstatus") == "F", "PAID").otherwise("DUE").alias("payment_status"),
            F.col("o_totalprice").cast(MONEY).alias("order_amount"),
            F.lit("GBP").alias("currency"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def stg_payments(self) -> DataFrame:
        li = self.raw("lineitem")
        p = F.col("l_extendedprice")
        return li.select(
            line_id().alias("payment_id"),
            F.col("l_orderkey").alias("order_id"),
            F.when(F.col("l_linestatus") == "F", "success").otherwise("fail").alias("status"),
            F.when(F.col("l_returnflag") == "R", -p).otherwise(p).cast(MONEY).alias("amount"),
        )

    # ---- change logs for snapshots ------------------------------------------
    def crm_customer_changes(self) -> DataFrame:
        o = self.raw("orders")
        j = o.join(self._customer_nation().select("c_custkey", "n_name"),
                   F.col("o_custkey") == F.col("c_custkey"))
        k = F.col("o_orderkey")
        return j.select(
            k.alias("change_id"),
            F.col("o_custkey").alias("customer_id"),
            F.concat((k % 100).cast("string"), F.lit(" High Street")).alias("address_line1"),
            F.lit(None).cast("string").alias("address_line2"),
            F.concat(F.lit("City "), (k % 20).cast("string")).alias("city"),
            F.col("o_orderstatus").alias("state"),
            (10000 + k % 90000).cast("string").alias("postal_code"),
            F.col("n_name").alias("country"),
            F.col("o_orderdate").alias("last_updated_at"),
        )

    def hr_employee_roles(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.col("event_id").alias("change_id"),
            F.col("user_id").alias("employee_id"),
            F.col("event_type").alias("role"),
            F.when(F.col("value") > 50, "A").otherwise("B").alias("department"),
            F.col("ts").alias("role_last_updated"),
        )

    def product_prices(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(
            line_id().alias("change_id"),
            F.col("l_partkey").alias("product_code"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_shipdate").alias("last_updated_at"),
        )

    def meter_reads(self) -> DataFrame:
        e = self.raw("events")
        hh = F.hour("ts") * 2 + F.when(F.minute("ts") >= 30, 1).otherwise(0)
        return e.select(
            F.col("event_id").alias("read_id"),
            F.col("user_id").alias("meter_id"),
            F.when(F.col("event_id") % 2 == 0, "AI").otherwise("RI").alias("qty"),
            F.col("event_type").alias("register"),
            F.col("ts").cast("date").alias("read_day"),
            hh.cast("int").alias("hh"),
            F.col("value").cast(MONEY).alias("reading"),
            F.when(F.col("event_type") == "error", "E").otherwise("A").alias("flag"),
        )

    # ---- seeds (fixed, small: safe to broadcast) ----------------------------
    def seed_country_risk(self) -> DataFrame:
        m = F.col("n_nationkey") % 5
        return self.raw("nation").select(
            F.col("n_name").alias("country_code"),
            F.when(m == 0, "HIGH").when(m == 1, "MEDIUM").otherwise("LOW").alias("risk_level"))

    def seed_aml_thresholds(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(a, b) for a, b in AML_THRESHOLDS], "rule_name string, threshold_value int"
        ).select("rule_name", F.col("threshold_value").cast(MONEY).alias("threshold_value"))

    def seed_insolvency_codes(self) -> DataFrame:
        return self.spark.createDataFrame([(c,) for c in INSOLVENCY_CODES], "insolvency_code string")

    def bank_holidays(self) -> DataFrame:
        return self.spark.createDataFrame([(d,) for d in BANK_HOLIDAYS], "h string").select(
            F.col("h").cast("date").alias("holiday_date"))


for _n, _f in list(vars(Tables).items()):
    if callable(_f) and not _n.startswith("_") and _n not in ("raw", "restrict"):
        setattr(Tables, _n, _memo_adapter(_f))
