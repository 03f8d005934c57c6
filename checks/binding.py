"""The fourteen logical tables derived from the driver's tables.

Customers act as creditors, four of them form an organisation, line items are
payments, orders are exposure snapshots, predictions, opportunities and
tickets, events are score reports, balances and the result log. Events are
moved back by whole days so that all tables share one run date.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date, timedelta
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwatch.operators.staging import shared_folder
from riskwatch.sources.payment_events import write_payment_events
from riskwatch.sources.seen import refresh_seen
from riskwatch.sources.tables import Sources

AS_OF = date(2001, 8, 2)
# Days between the events' last day and the day before AS_OF.
EVENT_SHIFT = (date(2024, 1, 30) - date(2001, 8, 1)).days


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def creditor(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "concat('CR', c_custkey) AS id",
        "concat('OR', c_custkey div 4) AS organisation_id",
        "c_name AS name",
        "concat('G', c_nationkey) AS geo",
        "CASE WHEN c_nationkey <> 24 THEN c_mktsegment END AS merchant_category_code",
        "lower(c_mktsegment) AS merchant_category_code_description",
        "concat('label ', c_nationkey % 3) AS creditor_risk_label_parent",
        """CASE c_nationkey WHEN 0 THEN 'in_administration' WHEN 1 THEN 'insolvency'
           WHEN 2 THEN 'restructuring' WHEN 3 THEN 'dissolved' WHEN 4 THEN 'liquidation'
           WHEN 5 THEN 'inactivity' WHEN 6 THEN NULL ELSE 'in_review' END AS creditor_risk_label_detail""",
        """CASE WHEN c_nationkey <> 6 THEN
           CAST(date_add(DATE '2000-01-01', CAST(c_custkey % 550 AS INT)) AS TIMESTAMP_NTZ) END
           AS most_recent_risk_label_created_at""",
        "date_add(DATE '1999-01-01', CAST(c_custkey % 700 AS INT)) AS creditor_created_date",
        "c_acctbal < -900 AS is_account_closed",
        """CASE c_nationkey WHEN 7 THEN true WHEN 8 THEN CAST(NULL AS BOOLEAN) ELSE false END
           AS is_payment_provider""",
        "true AS organisation_with_multiple_creditors",
    )


def organisation(customer: DataFrame) -> DataFrame:
    grouped = customer.selectExpr("c_custkey div 4 AS g", "c_custkey", "c_acctbal", "c_nationkey").groupBy("g")
    return (
        grouped.agg({"c_custkey": "min", "c_acctbal": "min", "c_nationkey": "max"})
        .selectExpr(
            # Groups with a large debt have a key that no creditor has.
            "concat(CASE WHEN `min(c_acctbal)` < -900 THEN 'XO' ELSE 'OR' END, g) AS organisation_id",
            "CASE WHEN g % 13 <> 5 THEN concat('CR', `min(c_custkey)`) END AS creditor_id",
            "concat('Group ', g) AS name",
            "concat('G', `max(c_nationkey)`) AS geo",
            "concat('AC', g) AS account_id",
            """CASE WHEN g % 17 = 4 THEN NULL WHEN g % 17 = 9 THEN 'n/a'
               ELSE CAST(7200 + (g * 13) % 800 AS STRING) END AS merchant_category_code""",
            """TIMESTAMP_NTZ '2001-08-02 09:30:00' - make_dt_interval(CAST(g % 10 AS INT)) AS created_at""",
            "concat('type ', g % 2) AS current_revenue_account_type",
            """CASE g % 11 WHEN 3 THEN 'preactive' WHEN 7 THEN NULL ELSE 'active' END AS current_state""",
            "CASE WHEN g % 6 <> 5 THEN concat('PA', g div 6) END AS parent_account_id",
            "CASE WHEN g % 6 <> 5 THEN concat('Parent \"', g div 6, '\"') END AS parent_account_name",
            "CASE g % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_cs_managed",
            "CASE WHEN g % 3 = 0 THEN concat('Manager ', g % 7) END AS csm_owner_name",
            "CASE g % 4 WHEN 0 THEN true WHEN 1 THEN false END AS is_cs_managed_salesforce",
            """CASE g % 5 WHEN 0 THEN 'CS Managed - SB' WHEN 1 THEN 'CS Managed - Ent&MM'
               WHEN 2 THEN NULL ELSE 'Self Serve' END AS parent_account_stage""",
        )
    )


def organisation_fact(orders: DataFrame) -> DataFrame:
    counted = orders.selectExpr(
        "o_custkey div 4 AS g",
        """CASE WHEN o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '2001-01-01'
           THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount""",
    )
    return (
        counted.groupBy("g")
        .agg({"amount": "sum"})
        .selectExpr(
            "concat('OR', g) AS organisation_id",
            """CASE WHEN g % 7 = 2 THEN CAST(0 AS DECIMAL(18,2))
               ELSE CAST(`sum(amount)` AS DECIMAL(18,2)) END AS total_payment_gbp_amount_in_all_time""",
        )
    )


def opportunity(orders: DataFrame) -> DataFrame:
    # Most belong to accounts that no organisation has.
    account = "CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'AC' ELSE 'XA' END"
    return orders.selectExpr(
        f"concat({account}, o_custkey div 4) AS account_id",
        "concat('OP', o_orderkey) AS opportunity_id",
        "CAST(o_orderdate AS DATE) AS opportunity_created_date",
    )


def exposure(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "concat('CR', o_custkey) AS creditor_id",
        "o_totalprice AS amount_gbp",
        "CAST(o_orderdate AS DATE) AS calculated_at_date",
    )


def score_report(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('CR', user_id) AS creditor_id",
        f"ts - make_dt_interval({EVENT_SHIFT}) AS retrieved_at",
        """named_struct('failure_score', named_struct('national_percentile',
           CASE WHEN event_type <> 'signup' THEN CAST(floor(value) AS BIGINT) % 101 END)) AS dnb_assessment""",
        "named_struct('has_insolvency', event_type = 'error') AS legal_events",
    )


def default_prediction(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "concat('CR', o_custkey) AS creditor_id",
        "date_format(o_orderdate, 'yyyyMMdd') AS prediction_date",
        "o_totalprice / 1000000 AS probability",
    )


def daily_balance(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "concat('CR', user_id) AS owner_id",
        "CASE WHEN event_type = 'error' THEN 'reserve' ELSE 'available_merchant_funds' END AS name",
        f"CAST(ts - make_dt_interval({EVENT_SHIFT}) AS DATE) AS calendar_date",
        "CAST((value - 40) * 1000 AS DECIMAL(18,2)) AS balance_amount_sum_gbp",
    )


def payment(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        "concat('CR', o_custkey) AS creditor_id",
        "l_extendedprice AS amount_gbp",
        "l_linestatus = 'F' AS is_paid",
        "l_returnflag = 'R' AS is_charged_back",
        "o_orderstatus = 'P' AS is_failed",
        "CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS is_late_failure",
        "l_returnflag = 'A' AS is_refunded",
        "o_orderdate AS charge_date",
        "l_shipdate AS charged_back_date",
        "l_shipdate + make_dt_interval(3 * l_linenumber) AS failed_or_late_failure_date",
        "l_shipdate - make_dt_interval(5 * l_linenumber) AS refund_created_at",
    )


def ticket(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS id",
        "o_orderdate AS created_at",
        "o_orderpriority AS subject",
        "o_custkey div 4 AS organization_id",
        "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS group_id",
    )


def ticket_field(lineitem: DataFrame) -> DataFrame:
    day = "date_format(l_shipdate, 'yyyy-MM-dd')"
    return lineitem.selectExpr(
        "l_orderkey AS ticket_id",
        """CASE l_linenumber WHEN 1 THEN 'Next Review Date' WHEN 2 THEN 'Reason for next review'
           WHEN 3 THEN 'Sanctioned Credit Risk Exposure' WHEN 4 THEN 'Sanctioned Date'
           ELSE 'Other' END AS ticket_field_title""",
        f"""CASE l_linenumber
            WHEN 1 THEN CASE WHEN l_returnflag = 'N' THEN substr({day}, 1, 7) ELSE {day} END
            WHEN 2 THEN concat('reason ', l_returnflag, l_linestatus)
            WHEN 3 THEN CASE WHEN l_returnflag = 'N' THEN '0'
                 ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END
            WHEN 4 THEN {day} ELSE l_linestatus END AS ticket_field_value""",
    )


def ticket_group(region: DataFrame) -> DataFrame:
    return region.selectExpr(
        "CAST(r_regionkey AS BIGINT) AS id",
        "CASE WHEN r_regionkey IN (1, 2) THEN 'Credit' ELSE r_name END AS name",
    )


def ticket_org(customer: DataFrame) -> DataFrame:
    return (
        customer.selectExpr("c_custkey div 4 AS id")
        .groupBy("id")
        .count()
        .selectExpr("id", "concat('OR', id) AS organisation_key")
    )


def result_log(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        """concat('{"creditor_id":"CR', user_id, '","ticket_id":',
           CASE WHEN event_type = 'click' THEN 'null' ELSE concat('"', event_id, '"') END,
           ',"cb_rate_30days":', CAST(CAST(value / 1000 AS DECIMAL(10,5)) AS STRING),
           ',"nb_balance_current":-', CAST(CAST(value * 100 AS DECIMAL(18,2)) AS STRING), '}') AS values""",
        f"ts - make_dt_interval(CAST({EVENT_SHIFT} + (user_id % 3) * 60 AS INT)) AS runtime",
        "CASE WHEN event_type = 'error' THEN 'debug' ELSE 'result' END AS logtype",
        """CASE WHEN event_type IN ('purchase', 'view') THEN 'credit_chargeback_monitoring'
           ELSE 'credit_negative_balance' END AS process_name""",
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    read = cache(lambda name: raw(spark, sf_dir, name))

    def over(build, *names: str):
        return lambda: build(*map(read, names))

    return Sources({
        "creditor": over(creditor, "customer"),
        "organisation": over(organisation, "customer"),
        "organisation_fact": over(organisation_fact, "orders"),
        "opportunity": over(opportunity, "orders"),
        "exposure": over(exposure, "orders"),
        "score_report": over(score_report, "events"),
        "default_prediction": over(default_prediction, "orders"),
        "daily_balance": over(daily_balance, "events"),
        "payment": over(payment, "lineitem", "orders"),
        "ticket": over(ticket, "orders"),
        "ticket_field": over(ticket_field, "lineitem"),
        "ticket_group": over(ticket_group, "region"),
        "ticket_org": over(ticket_org, "customer"),
        "result_log": over(result_log, "events"),
    })


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a kept table: in the shared one, or where none is set locally."""
    parent = shared_folder(spark) or tempfile.mkdtemp(prefix="riskwatch-")
    return f"{parent}/{name}-{uuid.uuid4().hex}"


def with_seen(spark: SparkSession, sf_dir: str) -> Sources:
    """Sources with a kept table of paying creditors: built ten days ago from the
    payments of then, brought up to date today."""
    tables, path = sources(spark, sf_dir), scratch(spark, "seen")
    before = AS_OF - timedelta(days=10)
    payments = tables.table("payment")
    refresh_seen(spark, tables.replace(payment=payments.where(F.col("charge_date") < F.lit(before))), path, before)
    return refresh_seen(spark, tables, path, AS_OF)


def with_events(spark: SparkSession, sf_dir: str) -> Sources:
    """Sources with payments stored by event date."""
    tables, path = sources(spark, sf_dir), scratch(spark, "events")
    write_payment_events(tables, path, AS_OF)
    return tables.replace(payment_event=spark.read.parquet(path))
