"""The names of the registered views resolve in SQL, and their numbers are the jobs' numbers."""

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerflow.plans.views import register_views


def test_last_balance_of_a_month_through_the_view(spark):
    register_views(spark, SF_SMALL)
    sql = spark.sql("""
        with ranked as (
          select account_id, currency_code, closing_balance, trunc(balance_date, 'month') as month_start,
                 row_number() over (partition by account_id, trunc(balance_date, 'month') order by balance_date desc) as place
          from fct_account_balance_daily)
        select account_id, month_start, currency_code, closing_balance as eom_closing_balance from ranked where place = 1""")
    job = E.queries()["eom_balance"](spark, SF_SMALL)
    assert sorted(sql.collect()) == sorted(job.select(*sql.columns).collect())


def test_reserves_by_product_and_day_through_three_views(spark):
    register_views(spark, SF_SMALL)
    sql = spark.sql("""
        with versions as (
          select policy_id, product_code, effective_from, ifnull(effective_to, date '9999-12-31') as until from dim_policy),
        days as (select date_day from dim_calendar where date_day between date '2001-05-03' and date '2001-08-01')
        select v.product_code, d.date_day as snapshot_date, sum(r.reserve_amount) as total_reserve
        from days d, fct_claim_reserve_snapshots r, versions v
        where r.snapshot_date = d.date_day and r.policy_id = v.policy_id
          and d.date_day >= v.effective_from and d.date_day < v.until
        group by v.product_code, d.date_day""")
    job = E.queries()["reserve_trend_90d"](spark, SF_SMALL)
    assert sorted(sql.collect()) == sorted(job.select(*sql.columns).collect())
